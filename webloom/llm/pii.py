"""Personal data replaced by keyed surrogates of the same type.

Every surrogate is a keyed permutation of the entities of one format: digits become digits,
vowels vowels, a name of a gender and script another of the same. Permutations are
one-to-one, so distinct entities stay distinct and an entity has the same surrogate in
every document, without a table of entities. They have no fixed points, so nothing stays
as it was. Spellings of one entity that differ in case, or in the separators of a number,
are one entity. A check of each document confirms both; where two entities had the same
surrogate all the same, the later one's is permuted on.

Every pattern reads a text in linear time, whatever stands in it.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
from collections.abc import Callable, Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import once, pick

_NAMES = {
    ("latin", "m"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew George Kevin Brian Edward Peter Hans Klaus Jürgen Wolfgang Stefan Andreas Matthias Uwe Dieter Heinz Jean Pierre Michel Philippe Alain Nicolas Laurent Olivier Christophe François Luc Antoine José Antonio Manuel Francisco Juan Javier Carlos Jesús Miguel Alejandro Rafael Pablo Luis Diego",
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Ashley Emily Donna Michelle Carol Amanda Anna Emma Ursula Monika Petra Sabine Renate Helga Karin Brigitte Ingrid Claudia Heike Gisela Marie Nathalie Isabelle Sylvie Catherine Françoise Martine Christine Sophie Camille Céline Juliette María Carmen Josefa Isabel Dolores Pilar Teresa Lucía Cristina Marta",
    ("cyrillic", "m"): "Александр Сергей Владимир Андрей Алексей Дмитрий Николай Иван Михаил Евгений Олег Павел Юрий Виктор Игорь Максим",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Людмила Юлия Галина Надежда Вера Любовь Дарья",
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Γιάννης Παναγιώτης Βασίλης Χρήστος Αντώνης Μιχάλης",
    ("greek", "f"): "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα Κωνσταντίνα Ιωάννα",
    ("english", "m"): "Christopher Brandon Justin Ryan Jason Jacob Nicholas Jonathan Stephen Benjamin Samuel Gregory Patrick Alexander Dennis Tyler Aaron Henry Douglas Nathan Zachary Kyle Walter Ethan Jeremy Harold Keith",
    ("english", "f"): "Kimberly Amy Angela Melissa Brenda Rebecca Stephanie Laura Sharon Cynthia Kathleen Shirley Debra Rachel Carolyn Janet Maria Heather Diane Julie Victoria Kelly Lauren Olivia Sophia Hannah Julia",
    ("indian", "m"): "Aarav Arjun Rahul Rohan Amit Vikram Sanjay Rajesh Suresh Ravi Anil Vijay Ajay Deepak Manoj Ashok Karan Nikhil Arun Harish",
    ("indian", "f"): "Priya Anjali Pooja Neha Kavita Sunita Lakshmi Divya Shreya Deepa Meera Nisha Rekha Swati Aishwarya Sneha Geeta Radha Usha",
    ("chinese", "any"): "Wei Xiaoming Yifan Haoran Zihan Jianguo Guoqiang Meiling Xiaoli Yuxin Jiahui Zixuan Junjie Zhiyong Weimin",
    ("slavic", "m"): "Ivan Dmitri Dmitry Sergei Sergey Alexei Vladimir Nikolai Mikhail Yuri Igor Oleg Boris Andrei Pavel Viktor Marek Piotr Tomasz Krzysztof",
    ("slavic", "f"): "Olga Natalia Tatiana Irina Svetlana Ekaterina Ludmila Yulia Elena Oksana Agnieszka Katarzyna Magdalena Zofia Anastasia Galina",
    ("arabic", "m"): "Mohammed Muhammad Ahmed Ali Hassan Hussein Omar Khalid Yusuf Ibrahim Mustafa Abdullah Karim Tariq Samir Mahmoud",
    ("arabic", "f"): "Fatima Aisha Zainab Khadija Maryam Layla Amina Salma Yasmin Hanan Samira",
    ("turkish", "m"): "Mehmet Emre Murat Burak Kemal Serkan",
    ("turkish", "f"): "Ayşe Zeynep Elif Emine Fatma Merve",
    ("japanese", "m"): "Hiroshi Takashi Kenji Haruto Satoshi Akira Yuto Daisuke",
    ("japanese", "f"): "Sakura Yuko Haruka Keiko Naoko Akiko Misaki",
    ("korean", "any"): "Minjun Seojun Jihoon Jiwoo Soojin Minji Jimin Hyunwoo",
}
_LISTS = {k: v.split() for k, v in _NAMES.items()}
_KIND = {n.casefold(): (k, i) for k, names in _LISTS.items() for i, n in enumerate(names)}
_TITLE = r"(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Hr|Fr|Monsieur|Madame|Mme|Mlle|Señora?|Sra?|Doña|Don|Г-н|Г-жа|Κος|Κα)\.?"
_CUE = r"(?:[Mm]y name is|[Nn]ame ?[:=]|[Ss]igned by|[Cc]ontact(?: person)? ?:|[Jj]e m['’]appelle|[Mm]ein Name ist|[Ii]ch heiße|[Mm]e llamo|[Mm]i nombre es|[Мм]еня зовут|[Мμ]ε λένε)"
#: A name is no longer than 40 letters a part; the bounds keep the search linear.
_CAP = r"[^\W\d_a-zß-öø-ÿа-яё][^\W\d_]{0,39}(?:[-'’][^\W\d_]{1,40}){0,3}(?![^\W\d_])"
_HAN = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕苏卢蒋蔡贾丁魏薛叶阎余潘杜戴夏钟汪田任姜范方石姚谭廖邹熊金陆郝孔白崔康毛邱秦江史顾侯邵孟龙万段雷钱汤尹黎易常武乔贺赖龚文"
_HAN_GIVEN = "伟芳娜敏静丽强磊军洋勇艳杰娟涛明超秀霞平刚桂英华玉兰红建国志文海波宇轩涵梓浩然欣怡佳琪雪梅"
_CJK = "぀-ヿ㐀-鿿"
#: A pattern begins with a set of characters, which the search skips to; what must not stand
#: before it is looked at behind the first character. The last group is the entity.
_PATTERNS: list[tuple[str, re.Pattern, Callable[[str], bool]]] = [
    ("secret", re.compile(r"(?i)\b(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key)\b(\s{0,8}[=:]\s{0,8}[\"']?)([A-Za-z0-9+/_\-]{8,})"), lambda t: "=" in t or ":" in t),
    ("secret", re.compile(r"\b((?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|(?=[0-9]*[a-fA-F])[0-9a-f]{32,}|(?=[0-9]*[A-F])[0-9A-F]{32,})\b"), lambda t: max(map(len, t.split()), default=0) >= 20),
    ("iban", re.compile(r"([A-Z](?<!\w[A-Z])[A-Z]\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b"), lambda t: True),
    ("ip6", re.compile(r"([0-9A-Fa-f:](?<![\w:.].)[0-9A-Fa-f:]{1,38})(?![\w:])"), lambda t: t.count(":") > 1),
    (
        "phone",
        re.compile(
            r"([+(\d](?:(?<=\+)(?<![\w+].)\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)|(?<=\()(?<![\w.].)\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)"
            r"|(?<=\d)(?<![\w.\-].)\d{2}[.\-]\d{3}[.\-]\d{4}(?![\d\-])|(?<=0)(?<![\w.,+\-/:].)\d{2,4}[ /\-]\d{5,8}(?![\w\-]|[.,]\d)))"
        ),
        lambda t: True,
    ),
    ("ssn", re.compile(r"(\d(?<![\w\-].)\d{2}-\d{2}-\d{4})(?![\w\-])"), lambda t: "-" in t),
    ("card", re.compile(r"(\d(?<!\d.)(?<!\d\..)(?:[ \-]?\d){12,18})(?!\d)"), lambda t: True),
    ("ip", re.compile(r"(\d(?<![\d.].)\d{0,2}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?!\d|\.\d)"), lambda t: t.count(".") > 2),
    ("han", re.compile(rf"(?:(?<![{_CJK}])|(?<=我叫)|(?<=名叫)|(?<=姓名)|(?<=联系人))([{_HAN}][一-鿿]{{1,2}}?)(?=先生|女士|小姐|老师|教授|医生|さん|様|氏|君|(?![{_CJK}]))"), lambda t: not t.isascii() and _IDEOGRAM.search(t) is not None),
]
_IDEOGRAM = re.compile("[一-鿿]")
_LOCAL = re.compile(r"[^\W_](?:[\w.%+\-]*[\w%+\-])?\Z")
_DOMAIN = re.compile(r"(?:[^\W_](?:[\w\-]{0,61}[^\W_])?\.)+[^\W\d_]{2,}")
_DIGIT = re.compile(r"\d")
_PERSON = re.compile(rf"(?:\b({_TITLE}|{_CUE})\s+)?\b({_CAP}(?:[ \t]+{_CAP}){{0,3}})")
_NEXT = re.compile(rf"{_CAP.replace('[^', '[^', 1).replace('ё]', 'ё](?<!\\w.)', 1)}[ \t]+{_CAP}")
_CALLED = re.compile(rf"\b(?:{_TITLE}|{_CUE})\s+{_CAP}")
#: Some of these stands in every text in which a title or a phrase is found.
_HINTS = ("Mr", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Hr", "Fr", "Mons", "Mad", "Mme", "Mlle", "Señor", "Sr", "Doña", "Don", "Г-", "Κ", "ame", "igned by", "ontact", "appelle", "heiße", "llamo", "nombre", "зовут", "λένε")
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")

#: Letters that may take each other's place, by script.
_GROUPS = ["0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "ñç", "åøæœěůőűęąăāēīōūı", "ßłšžčćřňşğźżśńđþð", "аеиоуыэюяё", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "άέήίόύώ", "βγδζθκλμνξπρστφχψ"]
_GROUP = {c: g for g in _GROUPS for c in g}
_HEX = "0123456789abcdef"
_EXAMPLE = re.compile(r"(?i)(?:^|\.)example\.(?:com|net|org)$")


def _hexadecimal(text: str) -> bool:
    return all(c in _HEX for c in text.lower()) and (text == text.lower() or text == text.upper())


def canonical(kind: str, text: str) -> str:
    """What all spellings of an entity have in common."""
    if kind in ("phone", "card", "ssn"):
        return text[:1].strip("(0123456789") + "".join(_DIGIT.findall(text))
    if kind == "ip6":
        return ipaddress.IPv6Address(text).exploded
    return text.replace(" ", "") if kind == "iban" else text.lower()


class Surrogates:
    """Keyed permutations. The same key gives the same surrogates everywhere."""

    ROUNDS = 8

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.known: dict[tuple[str, str], str] = {}

    def _f(self, tweak: str, r: int, x: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{tweak}|{r}|{x}".encode(), key=self.key, digest_size=64).digest(), "big")

    def _walk(self, tweak: str, n: int, x: int, back: bool) -> int:
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for r in range(self.ROUNDS - 1, -1, -1) if back else range(self.ROUNDS):
                if r % 2:
                    right = (right + (-1 if back else 1) * self._f(tweak, r, left)) % b
                else:
                    left = (left + (-1 if back else 1) * self._f(tweak, r, right)) % a
            x = left * b + right
            if x < n:
                return x

    def permute(self, tweak: str, n: int, x: int) -> int:
        """One-to-one on 0..n-1, without fixed points where n > 1: a keyed shift seen
        through a keyed Feistel network with cycle walking."""
        if n < 2:
            return x
        y = self._walk(tweak, n, x, False)
        return self._walk(tweak, n, (y + 1 + self._f(tweak, -1, n) % (n - 1)) % n, True)

    def recode(self, kind: str, text: str, alphabet: str | None = None) -> str:
        """Every letter and digit becomes another of its group; case and the rest stay."""
        low = [c.lower() if len(c.lower()) == 1 else c for c in text]
        groups = [alphabet if alphabet and c in alphabet else _GROUP.get(c) for c in low]
        value, n = 0, 1
        for c, g in zip(low, groups):
            if g:
                value, n = value * len(g) + g.index(c), n * len(g)
        form = "".join(c if not g else chr(0xE000 + (_GROUPS.index(g) if g in _GROUPS else 99)) for c, g in zip(low, groups))
        value = self.permute(f"{kind}|{form}", n, value)
        out = []
        for c, orig, g in zip(reversed(low), reversed(text), reversed(groups)):
            if g:
                value, i = divmod(value, len(g))
                c = g[i]
                out.append(c.upper() if orig != orig.lower() and len(c.upper()) == 1 else c)
            else:
                out.append(orig)
        return "".join(reversed(out))

    def _digits(self, kind: str, text: str, keep: int) -> str:
        """Digits recoded but for the first ``keep``; separators don't matter."""
        d = _DIGIT.findall(text)
        new = iter(d[:keep] + list(self.recode(f"{kind}|{''.join(d[:keep])}", "".join(d[keep:]))))
        return _DIGIT.sub(lambda m: next(new), text)

    def email(self, text: str) -> str:
        local, _, domain = text.rpartition("@")
        labels = domain.split(".")
        fixed = 2 if _EXAMPLE.search(domain) else 1
        host = ".".join(labels[:-fixed])
        new = self.recode("domain", host) if host else ""
        # a name that isn't of the example domains doesn't become one
        while host and fixed == 1 and _EXAMPLE.search(f"{new}.{labels[-1]}"):
            new = self.recode("domain", new)
        return self.recode("local", local) + "@" + ".".join(([new] if host else []) + labels[-fixed:])

    def _number(self, tweak: str, digits: str) -> str:
        """A leading zero stays and no other digit becomes one."""
        if not digits:
            return digits
        if digits[0] == "0":
            n = 10 ** (len(digits) - 1)
            return "0" + (f"{self.permute(f'{tweak}|0|{len(digits)}', n, int(digits)):0{len(digits) - 1}d}" if n > 1 else "")
        low = 10 ** (len(digits) - 1)
        return str(low + self.permute(f"{tweak}|{len(digits)}", 9 * low, int(digits) - low))

    def phone(self, text: str) -> str:
        """The country stays; so does a middle of 555, which no other number gets."""
        d = "".join(_DIGIT.findall(text))
        keep = 0 if not text.startswith("+") else 1 if d[0] in "17" else 2
        head, rest = d[:keep], d[keep:]
        if len(rest) != 10:
            new = self._number(f"phone|{head}", rest)
        elif rest[3:6] == "555":
            new = self._number(f"phone555|{head}", rest[:3] + rest[6:])
            new = new[:3] + "555" + new[3:]
        else:
            low, n = (0, 100) if rest[0] == "0" else (100, 900)
            mid = int(rest[3:6]) - (rest[3:6] > "555")
            x = ((int(rest[:3]) - low) * 999 + mid) * 10000 + int(rest[6:])
            x, last = divmod(self.permute(f"phone10|{head}|{low}", n * 9990000, x), 10000)
            first, mid = divmod(x, 999)
            new = f"{first + low:03d}{mid + (mid >= 555):03d}{last:04d}"
        fresh = iter(head + new)
        return _DIGIT.sub(lambda m: next(fresh), text)

    def ssn(self, text: str) -> str:
        return self._digits("ssn", text, 0)

    @staticmethod
    def _luhn(d: list[int]) -> int:
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10

    def card(self, text: str) -> str:
        """The first digit and the Luhn remainder stay, so valid numbers stay valid."""
        d = [int(c) for c in _DIGIT.findall(text)]
        middle = self.recode(f"card|{d[0]}", "".join(map(str, d[1:-1])))
        new = [d[0], *map(int, middle), 0]
        new[-1] = (self._luhn(d) - self._luhn(new)) % 10
        fresh = iter(new)
        return _DIGIT.sub(lambda m: str(next(fresh)), text)

    def iban(self, text: str) -> str:
        flat = text.replace(" ", "")
        rest = self.recode(f"iban|{flat[:2]}", flat[4:])
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        right = lambda part: 98 - number(part + flat[:2] + "00") % 97
        # as far from the right check digits as before, so right ones stay right
        check = f"{(right(rest) + int(flat[2:4]) - right(flat[4:])) % 100:02d}"
        new = iter(flat[:2] + check + rest)
        return "".join(c if c == " " else next(new) for c in text)

    def ip(self, text: str) -> str:
        a, b, c, d = map(int, text.split("."))
        x = a << 24 | b << 16 | c << 8 | d
        for bits, net in ((24, 10), (24, 127), (20, (172 << 4) | 1), (16, (192 << 8) | 168)):
            if x >> bits == net:
                x = net << bits | self.permute(f"ip|{net}", 1 << bits, x & (1 << bits) - 1)
                break
        else:
            private = lambda v: any(v >> bits == net for bits, net in ((24, 10), (24, 127), (20, 2753), (16, 49320)))
            x = self.permute("ip", 1 << 32, x)
            while private(x):
                x = self.permute("ip", 1 << 32, x)
        return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))

    def ip6(self, text: str) -> str:
        """The first 16 bits stay."""
        x = int(ipaddress.IPv6Address(text))
        new = str(ipaddress.IPv6Address(x >> 112 << 112 | self.permute("ip6", 1 << 112, x & (1 << 112) - 1)))
        return new.upper() if text != text.lower() else new

    def secret(self, text: str) -> str:
        if _hexadecimal(text):
            return self.recode("hex", text, _HEX)
        new = self.recode("secret", text)
        while _hexadecimal(new):
            new = self.recode("secret", new)
        return new

    def han(self, text: str) -> str:
        """The surname becomes another; usual characters of given names do likewise."""
        given = [_HAN_GIVEN.find(c) for c in text[1:]]
        value, n = 0, 1
        for g in given:
            if g >= 0:
                value, n = value * len(_HAN_GIVEN) + g, n * len(_HAN_GIVEN)
        value, out = self.permute(f"han|{''.join(' ' if g >= 0 else c for g, c in zip(given, text[1:]))}", n, value), []
        for g, c in zip(reversed(given), reversed(text[1:])):
            if g >= 0:
                value, i = divmod(value, len(_HAN_GIVEN))
                c = _HAN_GIVEN[i]
            out.append(c)
        return _HAN[self.permute("han surname", len(_HAN), _HAN.index(text[0]))] + "".join(reversed(out))

    def first_name(self, text: str) -> str:
        kind, i = _KIND[text.casefold()]
        names = _LISTS[kind]
        new = names[self.permute(f"name|{kind}", len(names), i)]
        return new.upper() if len(text) > 1 and text == text.upper() else new.lower() if text == text.lower() else new

    def name(self, text: str) -> str:
        """A given name becomes one of its gender and script, a surname is recoded."""
        if text.casefold() in _KIND:
            return self.first_name(text)
        new = self.recode("surname", text)
        while new.casefold() in _KIND:  # no surname becomes a given name of the lists
            new = self.recode("surname", new)
        return new

    def of(self, kind: str, text: str) -> str:
        new = self.known.get((kind, text))
        if new is None:
            new = getattr(self, kind)(text)
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[kind, text] = new
        return new


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: at most 64 characters before it and 255 after it are looked at."""
    at, before = text.find("@"), 0
    while at >= 0:
        low = max(before, at - 64)
        local = _LOCAL.search(text, max(low, text.rfind(" ", low, at) + 1), at)
        domain = local and _DOMAIN.match(text, at + 1, at + 256)
        if domain:
            yield local.start(), domain.end()
        before = at + 1
        at = text.find("@", domain.end() if domain else at + 1)


def _address(text: str) -> bool:
    if text.count(":") < 2 or _DIGIT.search(text) is None:
        return False
    try:
        return len(text) > 4 and not ipaddress.IPv6Address(text).is_unspecified
    except ValueError:
        return False


def _numbers(text: str) -> bool:
    return all(int(n) < 256 and (len(n) < 3 or n[0] != "0") for n in text.split("."))


_VALID: dict[str, Callable[[str], bool]] = {"ip6": _address, "ip": _numbers}


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, in order, not overlapping. Earlier kinds of the
    list of patterns win. A given name counts as a person if a surname or title is beside
    it; the parts of a person found once are persons wherever they stand in the text."""
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(text))

    def take(a: int, b: int, kind: str) -> None:
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\1" * (b - a)
            found.append((a, b, kind))

    digits = _DIGIT.search(text)
    for kind, pattern, worth in _PATTERNS:
        if (digits or kind in ("secret", "han")) and worth(text):
            for m in pattern.finditer(text):
                if _VALID.get(kind, bool)(m[pattern.groups]):
                    take(*m.span(pattern.groups), kind)
        if kind == "secret":
            for a, b in _emails(text):
                take(a, b, "email")
    parts: set[str] = set()
    if _NEXT.search(text) or any(h in text for h in _HINTS) and _CALLED.search(text):
        for m in _PERSON.finditer(text):
            words = m[2].split()
            given = [w for w in words if w.casefold() in _KIND]
            if (m[1] or len(words) > 1) and (given or m[1]) and (m[1] or len(given) < len(words) and words[0].casefold() in _KIND):
                parts.update(w.casefold() for w in words)
    if parts:
        for m in _WORD.finditer(text):
            if m[0][0] != m[0][0].lower() and m[0].casefold() in parts:
                take(*m.span(), "name")
    return sorted(found)


def pseudonymise(text: str | None, surrogates: Surrogates) -> tuple[str | None, int]:
    """(text with surrogates, how many were set)."""
    if not text:
        return text, 0
    spans = entities(text)
    if not spans:
        return text, 0
    out, at, owner = [], 0, {}
    for a, b, kind in spans:
        old = text[a:b]
        new, who = surrogates.of(kind, old), canonical(kind, old)
        tries = 0
        while owner.setdefault((kind, canonical(kind, new)), who) != who and tries < 100:
            new, tries = surrogates.of(kind, new), tries + 1
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), len(spans)


_OWN_KEYS: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The secret ``webloom.pii_key`` of the session's configuration. Where it is unset the
    application draws one for itself, so that nobody can reverse its surrogates; the next
    one then has others."""
    named = spark.conf.get("webloom.pii_key", None)
    if named:
        return named.encode()
    return _OWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_entities", T.LongType())])


def surrogate_text(text: Column | str, key: bytes) -> Column:
    """Column struct(text, n_entities). Null stays null, empty stays empty; texts of any
    length are searched whole."""

    @F.pandas_udf(RESULT)
    def replace(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Surrogates(key)
        for texts in parts:
            yield pd.DataFrame([pseudonymise(t if isinstance(t, str) else None, own) for t in texts], columns=RESULT.names).astype({"n_entities": "int64"})

    return once(replace)(F.col(text) if isinstance(text, str) else text)


def with_surrogates(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_entities) of every row; null ids and repeated rows are kept as they
    come; other columns are ignored."""
    df = pick(docs, id=id_col, text=text_col)
    return df.select(F.col("id").alias(id_col), surrogate_text("text", key).alias("s")).select(id_col, F.col("s.text").alias(text_col), "s.n_entities")
