"""Bring text that looks alike to one form.

Look-alike classes are found by union-find over strings and code points: a compatibility form and what it stands for, a decomposed
and a composed letter, letters of different scripts with one shape, all blank spaces, all invisible signs and the empty string. Of
each class the most frequent member in the corpus stands for all, and a multi-pattern automaton rewrites values from left to right,
the longest pattern first. Letters of other scripts are rewritten only where their word or value isn't wholly in that script.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that are drawn like a Latin letter, each before its Latin letter.
SAME_SHAPE = (
    "аa еe оo рp сc уy хx іi јj ѕs ԁd һh ѵv ԛq ԝw ӏl ӕæ ёë їï "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ԀD ҺH ѴV ԚQ ԜW ҮY ӀI ӔÆ ЁË ЇÏ "
    "οo νv αa ρp υu ιi κk γy ϲc ϳj χx όó άá έé ίí "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC "
    "օo սu հh ոn ցg զq ѡw ɡg ɑa ᴏo"
).split()
#: Scripts, by the start of their letters' names, that need the joiners; and scripts written with wide signs.
JOINING = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "ARABIC", "SYRIAC", "MONGOLIAN", "KHMER", "MYANMAR", "TIBETAN", "NKO", "THAI", "LAO")
WIDE = ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "BOPOMOFO", "IDEOGRAPHIC")
#: Compatibility forms whose look equals what they stand for; visibly different ones (raised, fractions) are left out.
SAME_LOOK = {"<wide>", "<narrow>", "<small>", "<font>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"}
#: Invisible code points that aren't of the category Cf, as ranges; the last of each is included.
INVISIBLE = ((0x34F, 0x34F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF))
#: Signs of the category Cf that are seen.
SEEN = ((0x600, 0x605), (0x6DD, 0x6DD), (0x70F, 0x70F), (0x8E2, 0x8E2), (0x110BD, 0x110BD))
#: Hyphens drawn like the typed one.
HYPHENS = "‐‑"
WORDS = regex.compile(r"[\p{L}\p{M}]+")


def _within(code: int, ranges: tuple[tuple[int, int], ...]) -> bool:
    return any(a <= code <= b for a, b in ranges)


def invisible(c: str) -> bool:
    """Whether a code point has no look of its own."""
    return _within(ord(c), INVISIBLE) or (unicodedata.category(c) == "Cf" and not _within(ord(c), SEEN))


@lru_cache(maxsize=65536)
def script(c: str) -> str:
    """The script of a letter or mark, as the first word of its name; '' of other characters."""
    return unicodedata.name(c, "").partition(" ")[0].partition("-")[0] if unicodedata.category(c)[0] in "LM" else ""


def plain(c: str) -> str | None:
    """What a compatibility or singleton form stands for, if it looks the same."""
    parts = unicodedata.decomposition(c).split()
    if not parts:
        return None
    tag = parts[0] if parts[0][0] == "<" else ""
    if not tag and len(parts) == 1:
        return unicodedata.normalize("NFC", c)
    if tag not in SAME_LOOK:
        return None
    whole = unicodedata.normalize("NFKC", c)
    if any(unicodedata.category(x)[0] == "M" for x in whole) or (tag == "<compat>" and not (whole.isalpha() or whole == " ")):
        return None
    return whole


@lru_cache(maxsize=1)
def compositions() -> dict[str, str]:
    """Every letter that is composed of a base and a mark, with these two; the base may be composed itself."""
    out = {}
    for code in range(0xA0, 0x20000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.normalize("NFC", chr(code)) == chr(code):
            out[chr(code)] = "".join(chr(int(p, 16)) for p in parts)
    return out


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        root = x
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def join(self, a: str, b: str) -> None:
        self.parent[self.find(a)] = self.find(b)

    def members(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return out


@dataclass
class Rewriter:
    """Rewrites values. forms: pattern to representative; letters: a letter to the members of its class by script."""

    forms: dict[str, str]
    letters: dict[str, dict[str, str]]
    _automaton: ahocorasick.Automaton | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {"forms": self.forms, "letters": self.letters, "_automaton": None}

    def _hits(self, text: str) -> Iterator[tuple[int, int, str]]:
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for pattern, to in self.forms.items():
                self._automaton.add_word(pattern, (len(pattern), to))
            self._automaton.make_automaton()
        for end, (length, to) in self._automaton.iter_long(text):
            yield end + 1 - length, end + 1, to

    def _replace(self, text: str) -> str:
        scripts = {script(c) for c in text} - {""}
        wide = bool(scripts) and all(s.startswith(WIDE) for s in scripts)
        leftward = any(unicodedata.bidirectional(c) in ("R", "AL") for c in text)
        out, at = [], 0
        for start, end, to in self._hits(text):
            old = text[start:end]
            if old in "‌‍᠎" and start and end < len(text) and script(text[start - 1]).startswith(JOINING) and script(text[end]).startswith(JOINING):
                continue
            if old in "‎‏؜" and leftward:
                continue
            if wide and (old == "　" or (unicodedata.east_asian_width(old[0]) == "F" and not to.isalnum())):
                continue
            if 0xFE00 <= ord(old[0]) <= 0xFE0F and start and unicodedata.category(text[start - 1]) == "So":
                continue
            out += [text[at:start], to]
            at = end
        return "".join([*out, text[at:]])

    def _unify(self, text: str) -> str:
        """Each word in one script, if its letters have a shape there."""
        words = [(m.start(), m.end(), {self._kind(c) for c in m.group()} - {""}) for m in WORDS.finditer(text)]
        latin = any("LATIN" in kinds for _, _, kinds in words)
        out, at = [], 0
        for start, end, kinds in words:
            word, to = text[start:end], None
            if len(kinds) > 1:
                # letters with a shape in one script only decide; then the number of letters, then Latin
                sole = Counter(self._kind(c) for c in word if c not in self.letters)
                count = Counter(self._kind(c) for c in word)
                to = next((s for s in sorted(kinds, key=lambda s: (-sole[s], -count[s], s != "LATIN")) if all(self._as(c, s) for c in word)), None)
            elif kinds and kinds != {"LATIN"} and latin and all(self._as(c, "LATIN") for c in word):
                to = "LATIN"
            if to:
                out += [text[at:start], "".join(self._as(c, to) for c in word)]
                at = end
        return "".join([*out, text[at:]])

    @staticmethod
    def _kind(c: str) -> str:
        return script(c) if unicodedata.category(c)[0] == "L" else ""

    def _as(self, c: str, to: str) -> str | None:
        if self._kind(c) in ("", to):
            return c
        return self.letters.get(c, {}).get(to)

    def rewrite(self, text: str | None) -> str | None:
        """The one form of a value; null stays null."""
        if text is None or text.isascii():
            return text
        met = set()
        while text not in met:
            met.add(text)
            text = self._unify(self._replace(text))
        # a form that rewrites to itself; of forms that lead to each other, which no classes give, the first one met again
        return text


def build_rewriter(counts: dict[str, int]) -> Rewriter:
    """Classes and representatives from the number of occurrences of each code point in the corpus."""
    classes, shapes = Classes(), Classes()
    pieces = {c for c in counts if not c.isascii()}
    for pair in SAME_SHAPE:
        shapes.join(pair[0], pair[1])
    for c in sorted(pieces):
        if (to := plain(c)) is not None and to != c:
            classes.join(c, to)
        elif invisible(c):
            classes.join(c, "")
        elif unicodedata.category(c) == "Zs" and c != " ":
            classes.join(c, " ")
        elif c in HYPHENS:
            classes.join(c, "-")
    for whole, parts in compositions().items():
        if parts[1] in counts:
            classes.join(parts, whole)

    def number(x: str) -> int:
        return min((counts.get(c, 0) for c in x), default=1 << 60)

    def best(members: list[str]) -> str:
        stable = [x for x in members if unicodedata.normalize("NFC", x) == x and all(plain(c) in (None, c) for c in x) and not any(invisible(c) for c in x)]
        return max(stable or members, key=lambda x: (x == "", x in (" ", "-"), number(x), x))

    forms = {}
    for members in classes.members().values():
        chosen = best(members)
        forms |= {x: chosen for x in members if x and x != chosen}
    letters: dict[str, dict[str, str]] = {}
    for members in shapes.members().values():
        by_script: dict[str, str] = {}
        for x in sorted(members, key=lambda x: (number(x), x)):
            by_script[script(x)] = x
        letters |= {x: by_script for x in members}
    return Rewriter(forms, letters)


def count_code_points(columns: list[DataFrame]) -> dict[str, int]:
    """How often each code point occurs in the (single, string) columns. At most one row for each code point of Unicode reaches the driver."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = Counter("".join(v for v in frame.iloc[:, 0] if v))
            if counts:
                yield pd.DataFrame({"c": list(counts), "n": list(counts.values())})

    parts = [df.mapInPandas(run, "c string, n long") for df in columns]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return {row.c: row.n for row in whole.groupBy("c").agg(F.sum("n").alias("n")).collect()}


def rewrite_values(df: DataFrame, column: str, rewriter: Rewriter) -> DataFrame:
    """The input with two more columns: plain_form, the one form of the value, and looks_typed, whether it was that already.

    Null stays null and counts as typed; empty and blank values stay; values of any length are rewritten whole.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            forms = [rewriter.rewrite(v) for v in frame[column]]
            yield frame.assign(plain_form=pd.Series(forms, index=frame.index, dtype=object), looks_typed=[a == b for a, b in zip(forms, frame[column], strict=True)])

    return df.mapInPandas(run, f"{kinds}, plain_form string, looks_typed boolean")


def plain_forms(tables: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """One form of the values of several columns, with classes and representatives from all of them together.

    tables: a table with entity_id, its column, and a name for it. Result: source, entity_id, value, plain_form, looks_typed, one
    row for each row.
    """
    rewriter = build_rewriter(count_code_points([df.select(column) for df, column, _ in tables]))
    parts = [rewrite_values(df.select(F.lit(name).alias("source"), "entity_id", F.col(column).alias("value")), "value", rewriter) for df, column, name in tables]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
