"""Upsert as one set-based plan: a full outer join of target and source, an action for
every pair, a new target and counts.

How rows of the source that share a key act: the last in order wins; the earlier ones
count as the insert or update they would have been. Conditions see the target as it was
before the statement, and both sides. Null keys match nothing, so they insert. Keys of the
whole source decide what is "not matched by source", whatever LIMIT lets through.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import quote_name, quote_text
from ..session import written

COUNTS = ("rows_inserted", "rows_updated", "rows_deleted")


@dataclass
class Clause:
    when: str  # matched, not_matched, not_matched_by_source
    action: str  # update, insert, delete, nothing
    condition: str | None = None
    assign: dict[str, str] | None = None


@dataclass
class MergeResult:
    rows: DataFrame  # the new target's columns and _action, _times
    columns: list[str]

    @property
    def target(self) -> DataFrame:
        return self.rows.where("_action not in ('delete', 'skip')").select(*(f"`{c}`" for c in self.columns))

    @property
    def counts(self) -> DataFrame:
        """One row: rows_inserted, rows_updated, rows_deleted."""
        n = lambda a: F.coalesce(F.sum(F.when(F.col("_action") == a, F.lit(1))), F.lit(0)).cast("long")
        more = F.coalesce(F.sum(F.when(F.col("_action").isin("insert", "update"), F.col("_times") - 1)), F.lit(0))
        return self.rows.agg(n("insert").alias(COUNTS[0]), (n("update") + more).cast("long").alias(COUNTS[1]), n("delete").alias(COUNTS[2]))


@dataclass
class Merge:
    """Builder: ``Merge(target, source, on=["url"]).when_matched_update()...``"""

    target: DataFrame
    source: DataFrame
    on: list[str] | dict[str, str]
    order: str | None = None
    target_name: str = "target"
    source_name: str = "source"
    clauses: list[Clause] = field(default_factory=list)
    most: int | None = None

    def when_matched_update(self, condition: str | None = None, assign: dict[str, str] | None = None) -> Merge:
        self.clauses.append(Clause("matched", "update", condition, assign))
        return self

    def when_matched_delete(self, condition: str | None = None) -> Merge:
        self.clauses.append(Clause("matched", "delete", condition))
        return self

    def when_not_matched_insert(self, condition: str | None = None, values: dict[str, str] | None = None) -> Merge:
        self.clauses.append(Clause("not_matched", "insert", condition, values))
        return self

    def when_not_matched_by_source_update(self, assign: dict[str, str], condition: str | None = None) -> Merge:
        self.clauses.append(Clause("not_matched_by_source", "update", condition, assign))
        return self

    def when_not_matched_by_source_delete(self, condition: str | None = None) -> Merge:
        self.clauses.append(Clause("not_matched_by_source", "delete", condition))
        return self

    def limit(self, n: int) -> Merge:
        """At most ``n`` source rows act, the first in order; rows missing from the source
        don't count."""
        self.most = n
        return self

    def result(self) -> MergeResult:
        t, s = self.target_name, self.source_name
        pairs = list(self.on.items()) if isinstance(self.on, dict) else [(c, c) for c in self.on]
        names = self.target.columns
        lower = {c.lower(): c for c in self.source.columns}
        # a column that only orders the source isn't a value
        held = {c.lower() for c in names}
        pick = [c for c in self.source.columns if c != self.order or c.lower() in held]
        seq = F.col(f"`{self.order}`") if self.order else F.monotonically_increasing_id()
        src = self.source.select(F.struct(*(F.col(f"`{c}`") for c in pick)).alias(s), seq.alias("_seq"))
        if not self.order:
            # the order is that of this one read, so it is kept
            src = written(src, "merge-source")
        keys = [F.col(f"{s}.`{b}`") for _, b in pairs]
        known = F.lit(True)
        for k in keys:
            known = known & k.isNotNull()
        w = Window.partitionBy(*keys)
        ranked = src.where(known).withColumn("_times", F.count("*").over(w)).withColumn("_last", F.row_number().over(w.orderBy(F.desc("_seq"))) == 1)
        src = ranked.where("_last").drop("_last").withColumn("_act", F.lit(True)).unionByName(src.where(~known).withColumn("_times", F.lit(1).cast("long")).withColumn("_act", F.lit(True)))
        tgt = self.target.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias(t))
        match = None
        for a, b in pairs:
            one = F.col(f"{t}.`{a}`") == F.col(f"{s}.`{b}`")
            match = one if match is None else match & one
        both = tgt.join(src, match, "full_outer")
        # unqualified names are the target's
        both = both.select(t, s, "_seq", "_times", *(F.col(f"{t}.`{c}`").alias(c) for c in names if c not in (t, s)))
        state = F.when(F.col(t).isNotNull() & F.col(s).isNotNull(), "matched").when(F.col(s).isNotNull(), "not_matched").otherwise("not_matched_by_source")
        chosen: Column | None = None
        for i, c in enumerate(self.clauses):
            test = (state == c.when) & (F.coalesce(F.expr(c.condition), F.lit(False)) if c.condition else F.lit(True))
            chosen = F.when(test, i) if chosen is None else chosen.when(test, i)
        both = both.withColumn("_clause", (F.lit(-1) if chosen is None else chosen.otherwise(-1)).cast("int")).withColumn("_state", state)
        if self.most is not None:
            acting = both.where("_clause >= 0 and _state <> 'not_matched_by_source'").select("_seq").orderBy("_seq").limit(self.most).select(F.col("_seq").alias("_allowed"))
            both = both.join(acting, F.col("_seq") == F.col("_allowed"), "left").withColumn("_clause", F.when((F.col("_state") != "not_matched_by_source") & F.col("_allowed").isNull(), -1).otherwise(F.col("_clause")))
        action = F.when((F.col("_clause") < 0) & (F.col("_state") == "not_matched"), "skip").when(F.col("_clause") < 0, "keep")
        for i, c in enumerate(self.clauses):
            nothing = "skip" if c.when == "not_matched" else "keep"
            action = action.when(F.col("_clause") == i, c.action if c.action != "nothing" else nothing)
        joined = {a.lower() for a, _ in pairs}
        out = []
        for c in names:
            old = F.col(f"{t}.`{c}`")
            kind = self.target.schema[c].dataType
            value = None
            for i, clause in enumerate(self.clauses):
                given = {k.lower(): v for k, v in clause.assign.items()} if clause.assign is not None else None
                if clause.action not in ("update", "insert"):
                    continue
                if given is not None:
                    new = F.expr(given[c.lower()]) if c.lower() in given else old if clause.action == "update" else F.lit(None)
                elif clause.when == "not_matched_by_source" or clause.action == "update" and c.lower() in joined:
                    new = old
                elif c.lower() in lower:
                    new = F.col(f"{s}.`{lower[c.lower()]}`")
                elif clause.action == "insert" and c.lower() in joined:
                    new = F.col(f"{s}.`{next(b for a, b in pairs if a.lower() == c.lower())}`")
                else:
                    new = old if clause.action == "update" else F.lit(None)
                test = F.col("_clause") == i
                value = F.when(test, new.cast(kind)) if value is None else value.when(test, new.cast(kind))
            out.append((old if value is None else value.otherwise(old)).alias(c))
        return MergeResult(both.select(*out, action.alias("_action"), F.coalesce("_times", F.lit(1)).alias("_times")), names)


def fresh_keys(source: DataFrame, target: DataFrame, on: list[str], fresh: str) -> DataFrame:
    """Source rows worth fetching: those without a target row for which ``fresh`` holds.
    Take the keys for "not matched by source" from the unfiltered source."""
    keep = target.where(fresh).select(*on)
    return source.join(keep, on, "left_anti")


def replace_table(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """The table holds ``rows`` from now on, which may be read from it. They are written
    beside it and the table is pointed to them in one step of the catalog, so that it is
    whole at any time, whatever fails."""
    name = quote_name(table)
    known = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {name}").collect()}
    old = known["Location"]
    new = f"{old.rstrip('/').rpartition('/')[0]}/{table.rpartition('.')[2].strip('`')}__{uuid.uuid4().hex}"
    rows.write.format(known.get("Provider", "parquet")).save(new)
    spark.sql(f"ALTER TABLE {name} SET LOCATION {quote_text(new)}")
    spark.catalog.refreshTable(name)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def merge_table(spark: SparkSession, table: str, merge: Merge) -> DataFrame:
    """Run a merge on a saved table: the new rows are written aside, then swapped in, so a
    failure leaves the table as it was. Returns the counts."""
    result = merge.result()
    done = MergeResult(written(result.rows, "merge-rows"), result.columns)
    replace_table(spark, table, done.target)
    return done.counts


def keyed_overwrite(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows replace those of the same key (state tables, caches)."""
    return target.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)
