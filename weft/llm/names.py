"""Names of organisations: their parts, keys to find candidates by, and how alike two of them are."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from weft.llm.lookalike import SAME_SHAPE

#: Legal forms, dots left out, and words that any firm may add.
LEGAL = frozenset(
    "inc incorporated llc llp lp ltd limited private pvt plc corp corporation company co gmbh ag kg ohg ug sa sas sarl srl spa bv nv ltda limitada "
    "eireli oy ab as aps pty pte sdn bhd kk sl slu p group groups enterprises enterprise services service".split()
)
#: Words that say what a firm does or is, not which one it is.
TRADE = frozenset(
    "tec const cons inds ind log eng engg engrg elect uphol bakery bakers textiles catering caterers upholstery cold storage stationery stationers international intl construction constructions constr builders insurance ins "
    "brokers travel travels agency agencies garments technologies technology tech engineering engineers industries industry foods food dental clinic dentist logistics "
    "landscaping associates assoc assocs book books depot hardware distributors distribution tea house furniture furnitures photography photo automobiles autos auto "
    "ceramics roofing steel works packaging opticians optical veterinary vet hospital nursery nurseries electricals electrical elec music store stores exports exporters printing printers "
    "brothers bros management mgt mgmt consultants consulting consultancy pharmacy pharma pharm dairy plumbing plumbers manufacturing manufacturers mfg jewellers "
    "jewelers jewellery jewelry security systems laboratories laboratory labs lab machine tools".split()
)
#: Words that carry nothing.
FILLER = frozenset("and n the of und et e y ms head office branch messrs".split())
#: Short and pet forms of given names, each after its full form.
PET_FORMS = (
    "benjamin ben benny benji|barbara barb babs barbie|charles chuck charlie chas|stephen steven steve|robert rob bob bobby robbie bert|william bill billy will willy wm|"
    "richard rick dick rich richie ricky|elizabeth liz beth betty eliza lizzie betsy|katherine kate kathy katie catherine cathy kathryn|james jim jimmy jamie|theodore ted theo teddy|"
    "edward ed eddie ned ted|margaret maggie meg peggy marge|patricia pat patty trish tricia|michael mike mick mickey|joseph joe joey jos|thomas tom tommy thos|samuel sam sammy|"
    "alexander alex sandy alec|andrew andy drew|anthony tony|christopher chris kit topher|daniel dan danny|deborah deb debra debbie|dorothy dot dottie dolly|"
    "frederick fred freddie freddy|geoffrey geoff jeff jeffrey|gregory greg|jennifer jen jenny|lawrence larry laurie laurence|leonard len lenny leo|penelope penny|philip phil pip phillip|"
    "raymond ray|rebecca becky becca|susan sue susie suzy|timothy tim timmy|victoria vicky tori vic|abigail abby gail|nicholas nick nicky|matthew matt|jonathan jon|gabriel gabe"
)
_SHAPES = str.maketrans({pair[0]: pair[1].lower() for pair in SAME_SHAPE})
_DOTTED = re.compile(r"\b[a-z](?:[./][a-z])+\b\.?")
_ALIAS = re.compile(r"\s*\(?\b(?:trading as|t/a|also known as|a/k/a|aka)\b.*")
_DBA = re.compile(r".*\b(?:dba|d/b/a|doing business as)\b")
_EDGE = re.compile(r"^\s*(?:m/s\.?|the|messrs\.?)\s+|\s+-\s+(?:head office|branch|h\.?o\.?)\s*$")
_TOKEN = re.compile(r"[^\W_]+")
#: Letters with the sound of another; a doubled sound is made single later.
SOUNDS = {"c": "k", "q": "k", "w": "v", "z": "s", "y": "i", "x": "ks"}
_SOUNDS = str.maketrans(SOUNDS)
_DOUBLE = re.compile(r"(.)\1+")


def fold(text: str | None) -> str:
    """Lower case without marks, invisible signs and compatibility forms; letters drawn like Latin ones made Latin; null gives ''."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    parts = unicodedata.normalize("NFKD", text)
    return "".join(c for c in parts if unicodedata.category(c) not in ("Mn", "Cf")).translate(_SHAPES).casefold().translate(_SHAPES)


@lru_cache(maxsize=100_000)
def sound(word: str) -> str:
    """A word with spellings that sound alike made equal."""
    w = word.replace("ph", "f").replace("ee", "i").replace("oo", "u").translate(_SOUNDS)
    return _DOUBLE.sub(r"\1", w[:1] + w[1:].replace("h", ""))


_INNER_H = re.compile(r"(?<=[^\n])h")


def sounds(words: list[str]) -> list[str]:
    """`sound` of each word, none of which holds a line break, in one pass over all."""
    if not words:
        return []
    text = "\n".join(words).replace("ph", "f").replace("ee", "i").replace("oo", "u")
    # one by one, as a table with a letter for two is slow; no sound is itself a letter with another's
    for letter, sound_ in SOUNDS.items():
        text = text.replace(letter, sound_)
    return _DOUBLE.sub(r"\1", _INNER_H.sub("", text)).split("\n")


PETS: dict[str, set[str]] = {}
for _entry in PET_FORMS.split("|"):
    for _form in _entry.split():
        PETS.setdefault(sound(_form), set()).add(sound(_entry.split()[0]))
#: Abbreviations of trade words; the one that is a word of its own is left out.
_STEMS = {t[:n] for t in TRADE if len(t) > 4 for n in range(4, len(t))} - {"engine"}


def _is_trade(token: str) -> bool:
    return token in TRADE or token in _STEMS


@dataclass(frozen=True, slots=True)
class Name:
    """core: words that tell the organisation apart, of a reference the most telling one first; trade: what it does; legal forms are left out.

    head: the first word of a name of few words, if it is so short that it may stand for initials.
    """

    core: tuple[str, ...]
    trade: tuple[str, ...]
    head: str

    def text(self) -> str:
        """The name as one string, from which `from_text` gives it back."""
        return f"{' '.join(self.core)}|{' '.join(self.trade)}|{self.head}"


    def node(self) -> str:
        """The same text for all names that are compared alike: two whole words in alphabetical order, trades by their first letters."""
        core = sorted(self.core) if len(self.core) == 2 and min(map(len, self.core)) >= 3 else self.core
        return f"{' '.join(core)}|{' '.join(sorted({t[:5] for t in self.trade}))}|{self.head}"


@lru_cache(maxsize=50_000)
def from_text(text: str) -> Name:
    core, trade, head = text.split("|")
    return Name(tuple(core.split()), tuple(trade.split()), head)


def parse(raw: str | None) -> Name:
    """The parts of a name as typed. Null, blank and purely legal names have no core."""
    text = fold(raw)
    if "dba" in text or "d/b/a" in text or "doing" in text:
        text = _DBA.sub("", text)
    # the patterns are costly, so each is tried only where what it must hold occurs
    if "aka" in text or "/" in text or "trading as" in text or "known as" in text:
        text = _ALIAS.sub("", text)
    if "-" in text or text.lstrip().startswith(("m/s", "the", "messrs")):
        text = _EDGE.sub("", _EDGE.sub("", text))
    text = text.replace("'", "").replace("’", "")
    if "." in text or "/" in text:
        text = _DOTTED.sub(lambda m: m.group().replace(".", "").replace("/", "") + " ", text)
    tokens = [t for t in _TOKEN.findall(text) if t not in FILLER]
    kept = [t for t in tokens if t not in LEGAL]
    core, trade = [], []
    for t in kept:
        (trade if _is_trade(t) else core).append(t)
    if not core and trade and len(kept) > 0:
        core, trade = [], trade
    head = tokens[0] if tokens and 2 <= len(tokens[0]) <= 5 and len(tokens) <= 4 and len(core) <= 1 else ""
    return Name(tuple(core), tuple(trade), head)


@lru_cache(maxsize=100_000)
def _places(a: str) -> dict[str, int]:
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    return where


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits."""
    find = _places(a).get
    row = full = (1 << len(a)) - 1
    for c in b:
        hit = find(c)
        if hit:
            hit &= row
            row = row + hit | row - hit
    return len(a) - (row & full).bit_count()


@lru_cache(maxsize=400_000)
def alike(a: str, b: str) -> float:
    """The longest-common-subsequence ratio of two words, by sound or by letters: twice the common length over both lengths."""
    if a == b:
        return 1.0
    x, y = sound(a), sound(b)
    if x == y:
        return 1.0
    ratio = 2 * lcs(x, y) / (len(x) + len(y))
    return ratio if ratio >= 0.9 else max(ratio, 2 * lcs(a, b) / (len(a) + len(b)))


@lru_cache(maxsize=200_000)
def _letters(word: str) -> tuple[int, int, int, int]:
    """The different letters of a word's sound as bits, their number with repeats, and the same of the word."""
    x, bits = sound(word), []
    for text in (x, word):
        out = 0
        for c in text:
            out |= 1 << (ord(c) & 63)
        bits.append(out)
    return bits[0], len(x), bits[1], len(word)


def may_be_alike(a: str, b: str, least: float) -> bool:
    """False only if `alike` is surely less than `least`: letters that one word hasn't are in no common subsequence."""
    x, m, s, k = _letters(a)
    y, n, t, j = _letters(b)
    return 2 * min(m - (x & ~y).bit_count(), n - (y & ~x).bit_count()) >= least * (m + n) or 2 * min(k - (s & ~t).bit_count(), j - (t & ~s).bit_count()) >= least * (k + j)


def same_given(a: str, b: str) -> bool:
    """Whether two words can be forms of one given name."""
    x, y = sound(a), sound(b)
    return x == y or not PETS.get(x, {x}).isdisjoint(PETS.get(y, {y}))


#: What an initial counts for.
INITIAL = 0.65


def word_score(full: str, typed: str) -> float:
    """How well a typed word stands for a full one: by likeness, pet form or abbreviation; an initial counts little."""
    if full == typed:
        return 1.0
    if same_given(full, typed):
        return 0.95
    x, y = sound(full), sound(typed)
    score = alike(full, typed)
    if len(y) >= 3 and len(y) < len(x):
        if x.startswith(y) or full.startswith(typed):
            return max(score, 0.9 if len(y) >= 4 or len(typed) >= 4 else 0.8)
        if len(y) >= 5:
            # a truncated word with a slip in it
            score = max(score, 0.9 * lcs(full[: len(typed)], typed) / len(typed) if len(typed) + 2 < len(full) and full[0] == typed[0] else 0.0)
    if len(typed) == 1 and full[:1] == typed:
        return INITIAL
    return score


def options(core: tuple[str, ...]) -> Iterator[tuple[str, int, int]]:
    """Words of a core and joins of two or three neighbours, as (word, first, last)."""
    for i, a in enumerate(core):
        yield a, i, i
        if i + 1 < len(core):
            yield a + core[i + 1], i, i + 1
            if i + 2 < len(core):
                yield a + core[i + 1] + core[i + 2], i, i + 2
    if len(core) == 2:
        yield core[1] + core[0], 0, 1


def compare(reference: Name, typed: Name) -> tuple[float, float, float, float]:
    """(main, second, trade, left): how well the reference's telling word (the first of its core), its other words and its trade are found.

    second is -1 where the typed name has no word left for the others, trade -1 where one has no trade; left is the part of the typed
    core's letters that stands for nothing of the reference.
    """
    if not reference.core or not typed.core:
        return 0.0, -1.0, -1.0, 1.0
    word, rest = reference.core[0], reference.core[1:]
    main, taken, spare = 0.0, (0, -1), ""
    if word in typed.core:
        i = typed.core.index(word)
        main, taken = 1.0, (i, i)
    else:
        size = len(word)
        for option, a, b in options(typed.core):
            length = len(option)
            if length < 3 or (b > a and abs(length - size) > 2):
                continue
            # beyond these lengths neither likeness nor truncation can count
            score, tail = word_score(word, option) if 2 * min(size, length) >= 0.7 * (size + length) or length < size else 0.0, ""
            if a == b and score < 0.9 and rest and length > size + 2 and option[0] in word[0] + "".join(r[0] for r in rest):
                # two words written as one
                for cut in (size, size - 1, size + 1):
                    for head, other in ((option[:cut], option[cut:]), (option[-cut:], option[:-cut])):
                        joint = alike(word, head)
                        if joint >= 0.8 and joint > score and other:
                            joint = min(joint, max(word_score(r, other) for r in rest))
                            if joint >= 0.8 and joint > score:
                                score, tail = joint, other
            if score > main:
                main, taken, spare = score, (a, b), tail
    if main < 0.5:
        return main, -1.0, -1.0, 1.0
    others = [*([spare] if spare else []), *typed.core[: taken[0]], *typed.core[taken[1] + 1 :]]
    seconds = []
    whole = max(1, sum(map(len, typed.core)))
    for r in rest:
        if not others:
            break
        if r in others:
            seconds.append(1.0)
            others.remove(r)
            continue
        choice = max((o for o in options(tuple(others)) if o[1] == o[2] or abs(len(o[0]) - len(r)) <= 2), key=lambda o: word_score(r, o[0]))
        value = word_score(r, choice[0])
        seconds.append(value)
        if value >= 0.55:
            del others[choice[1] : choice[2] + 1]
    second = sum(seconds) / len(seconds) if seconds else -1.0
    trade = compare_trades(reference.trade, typed.trade)
    return main, second, trade, sum(map(len, others)) / whole


def compare_trades(reference: tuple[str, ...], typed: tuple[str, ...]) -> float:
    """How well the words of a reference's trade are found among typed ones; -1 where one side has none."""
    if not reference or not typed:
        return -1.0
    hits = [max(1.0 if r.startswith(t) or t.startswith(r) else 0.9 if abbreviates(t, r) else alike(r, t) for t in typed) for r in reference]
    return max(hits) if len(typed) < len(reference) else sum(hits) / len(hits)


def abbreviates(short: str, word: str) -> bool:
    """Whether a word of three letters or more has the start of another, or its first letter and only letters of it in order."""
    return len(short) >= 3 and (short[:3] == word[:3] or (short[0] == word[0] and lcs(word, short) == len(short)))


def is_acronym(reference: Name, typed: Name) -> bool:
    """Whether the typed name's head is the initials of the reference's words, in any order, and its other words are of the reference's trade."""
    initials = sorted(w[0] for w in reference.core + reference.trade)
    others = [w for w in typed.core + typed.trade if w != typed.head]
    return len(typed.head) >= 2 and len(initials) >= 2 and sorted(typed.head) == initials and all(any(r.startswith(w) or w.startswith(r) for r in reference.trade) for w in others)


def matches(scores: tuple[float, float, float, float]) -> bool:
    """Whether the scores of `compare` tell one organisation: its telling word, and the other word unless it is missing."""
    main, second, trade, left = scores
    if second < 0:
        return main >= 0.9 and left <= 0.25 and (trade < 0 or trade >= 0.5)
    if second >= 0.75:
        return left <= 0.45 and (main >= 0.9 or (main >= 0.82 and (trade < 0 or trade >= 0.5)) or (main >= 0.8 and trade >= 0.9))
    return left <= 0.3 and (trade < 0 or trade >= 0.5) and ((second == INITIAL and main >= 0.88) or (second >= 0.68 and main >= 0.92))


def strength(scores: tuple[float, float, float, float]) -> float:
    """One number by which the matches of one typed name are ranked."""
    main, second, trade, left = scores
    return main + max(second, 0.5) + 0.3 * max(trade, 0.5) - left
