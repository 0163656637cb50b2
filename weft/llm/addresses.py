"""Postal addresses: their levels as written, and a top-down comparison of two of them, level by level."""

from __future__ import annotations

import re
from dataclasses import dataclass

from weft.llm.names import alike, fold, may_be_alike, sound

#: Kinds of streets, each before its other writings.
KIND_WRITINGS = (
    "road rd raod|street st str|avenue ave av aven|lane ln la|drive dr drv|court ct crt|boulevard blvd boul bvd|highway hwy hiway hway|parkway pkwy pky|terrace ter terr|"
    "market mkt|marg mg|nagar ngr|colony col clny|extension ext extn|layout lyt|cross x|main mn|platz pl|weg wg|rua r|avenida|alameda al alam|travessa tv trav|square sq|place|close|way"
)
KIND_OF = {w: entry.split()[0] for entry in KIND_WRITINGS.split("|") for w in entry.split()}
STREET_KINDS = frozenset(KIND_OF.values())
DIRECTIONS = frozenset("north n no south s so east e west w".split())
#: Words before the number of a part of a building; and whole parts without a number.
UNIT_WORDS = r"(?:shop|suite|ste|unit|floor|flr|fl|room|rm|flat|apt|apartment|building|bldg|block|blk|wing|level|office|door)"
#: Words whose numbers may belong to a part of a building, or that start a landmark.
PARTS = frozenset("shop suite ste unit floor flr fl room rm flat apt apartment building bldg block blk wing level office door near opp opposite behind beside next adjacent nr no rear st nd rd th ground first top upper lower".split())
_UNIT = re.compile(
    rf"\b(?:ground|first|top|upper|lower|\d+(?:st|nd|rd|th))\s*(?:floor|flr|fl)\b\.?|\b(?:fl|floor|flr)\b\.?\s*(?:no\.?\s*|#\s*)?\d{{1,2}}\b(?!-)|\b(?!fl\b){UNIT_WORDS}\b\.?\s*(?:no\.?\s*|nr\.?\s*|#\s*)?(?:\d{{1,4}}[a-z]?|[a-z])\b(?![-\w])|\b[a-z]\s+wing\b|\brear\b"
)
_LANDMARK_WORD = r"(?:near|opp|opposite|behind|beside|next to|adjacent to|nr\.? to)"
#: What a landmark's name ends with, so that it ends there when no separator does.
_LANDMARK = re.compile(rf"\b{_LANDMARK_WORD}\b\.?\s+(?:(?:[^\W\d_]+\s+){{0,2}}?(?:hospital|tower|hall|station|market|ground|pump|arch|exchange|atm|bank|tank|cinema|garden|gate(?:\s+\d{{1,2}}\b)?|stand|school|temple|park|mall)\b|[^,;\-]*)")
_HOUSE = re.compile(r"\b(?:h\s*\.?\s*no|d\s*\.?\s*no|plot\s*no|house\s*no|door\s*no|hno|dno|no|nr|number|num|n[°º])\b\s*\.?\s*#?\s*(\d{1,4}(?:\s*[-/]\s*\d{1,4}){0,3}[a-z]?)\b(?![-/\d])")
_POST = re.compile(r"(?<![\d-])(\d{5}-\d{3}|\d{6}|\d{5})(?![\d-])")
_POST_SPLIT = re.compile(r"(?<![\d\-/#])(\d{3})\s(\d{3})(?![\d-])")
_HASH = re.compile(r"#\s*(\d{1,4}(?:[-/]\d{1,4}){0,3})\b")
LANDMARK_WORDS = frozenset("near opp opposite behind beside next adjacent nr".split())
HOUSE_WORDS = frozenset("no nr hno dno number num n".split())
_ALL_WORDS = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"(?<![\w\-/])(\d{1,4}(?:[-/]\d{1,4}){1,3}|\d{1,4})(?![\w/]|-\d)")
_WORD = re.compile(r"[^\W\d_]+|\d+(?:st|nd|rd|th)\b")
#: Ordinals that name streets.
ORDINALS = {"1st": "first", "2nd": "second", "3rd": "third", "4th": "fourth", "5th": "fifth", "6th": "sixth", "7th": "seventh", "8th": "eighth", "9th": "ninth"}
_REGION_TAIL = re.compile(r"\s+-\s+[a-z]{2}$")


@dataclass(frozen=True, slots=True)
class Address:
    """As written. numbers: what may be the house number; codes: postal codes; words: all other words in order; units are left out."""

    numbers: tuple[str, ...]
    codes: tuple[str, ...]
    words: tuple[str, ...]

    def text(self) -> str:
        return f"{' '.join(self.numbers)}|{' '.join(self.codes)}|{' '.join(self.words)}"


@dataclass(frozen=True, slots=True)
class Place:
    """A building of the reference: its levels from the top."""

    region: str
    locality: str
    code: str
    street: str
    number: str

    def text(self) -> str:
        return "|".join((self.region, self.locality, self.code, self.street, self.number))


def address_from(text: str) -> Address:
    numbers, codes, words = text.split("|")
    return Address(tuple(numbers.split()), tuple(codes.split()), tuple(words.split()))


def place_from(text: str) -> Place:
    return Place(*text.split("|"))


def _stem(word: str) -> str:
    """A street name without a kind written onto it."""
    for tail in ("strasse", "strase", "str"):
        if word.endswith(tail) and len(word) > len(tail) + 3:
            return word[: -len(tail)]
    return word


def _numbered(raw: str) -> str:
    return re.sub(r"\s*[-/]\s*", "-", raw.strip())


def read_address(raw: str | None) -> Address:
    """The levels of an address as typed, in any order. Null and blank give an empty one."""
    text = fold(raw).replace("_", " ").replace("lay out", "layout")
    # the patterns are costly, so each is tried only where a word of its own occurs
    words_there = set(_ALL_WORDS.findall(text))
    if words_there & LANDMARK_WORDS:
        text = _LANDMARK.sub(" ; ", text)
    if words_there & PARTS:
        text = _UNIT.sub(" ; ", text)
    codes = [m.replace("-", "") for m in _POST.findall(text)]
    if codes:
        text = _POST.sub(" ", text)
    else:
        split = _POST_SPLIT.search(text)
        if split:
            codes = [split.group(1) + split.group(2)]
            text = text[: split.start()] + " " + text[split.end() :]
    marked: list[str] = []
    if words_there & HOUSE_WORDS:
        marked = [_numbered(m) for m in _HOUSE.findall(text)]
        text = _HOUSE.sub(" ", text)
    hashed: list[str] = []
    if "#" in text:
        hashed = [_numbered(m) for m in _HASH.findall(text)]
        text = _HASH.sub(" ", text)
    bare = [_numbered(m) for m in _NUMBER.findall(text)]
    words = [ORDINALS.get(w, w) for w in _WORD.findall(text)]
    numbers = marked or bare or hashed
    return Address(tuple(dict.fromkeys(numbers)), tuple(dict.fromkeys(codes)), tuple(KIND_OF.get(w) or _stem(w) for w in words if len(w) > 1 or w in KIND_OF))


def read_place(raw: str | None) -> Place | None:
    """The building of a well-formed address, whose parts stand in order between commas; None if it doesn't tell one."""
    text = fold(raw)
    if not text:
        return None
    parts = []
    for part in text.split(","):
        part = _LANDMARK.sub("", part)
        part = _UNIT.sub("", part).strip(" -")
        if part:
            parts.append(part)
    if len(parts) < 2:
        return None
    last = parts[-1]
    code = _POST.search(last)
    rest = _POST.sub("", last).strip(" -")
    region = locality = ""
    if rest and code and code.start() == 0:
        locality, body = rest, parts[:-1]
    elif rest and code:
        region, locality, body = rest, parts[-2], parts[:-2]
    elif code:
        locality, body = parts[-2], parts[:-2]
    else:
        locality, body = last, parts[:-1]
    tail = _REGION_TAIL.search(locality)
    if tail:
        region, locality = locality[tail.start() :].strip(" -"), locality[: tail.start()]
    number = ""
    words: list[str] = []
    for part in body:
        if not number:
            found = _NUMBER.search(_HOUSE.sub(lambda m: f" {m.group(1)} ", part))
            if found:
                number = _numbered(found.group(1))
        if not words:
            words = [KIND_OF.get(w) or ORDINALS.get(w) or _stem(w) for w in _WORD.findall(part)]
    kept = [w for w in words if w not in STREET_KINDS and w not in DIRECTIONS] or [w for w in words if w not in DIRECTIONS]
    if not number or not kept:
        return None
    return Place(region, " ".join(_WORD.findall(locality)), code.group().replace("-", "") if code else "", " ".join(kept), number)


#: The least likeness of a street or a locality that counts.
CLOSE_STREET, CLOSE_LOCALITY = 0.72, 0.75


def find_phrase(phrase: str, words: tuple[str, ...], least: float = 0.0) -> float:
    """How well the words of a phrase are found among some words (or joins of two neighbours): the lowest of their likenesses.

    What is less than `least` may be given as 0.
    """
    low = 1.0
    for p in phrase.split():
        if p in words:
            continue
        best = 0.0
        for i, w in enumerate(words):
            if abs(len(w) - len(p)) <= 3 and len(w) > 2 and may_be_alike(p, w, least):
                best = max(best, alike(p, w))
            if i + 1 < len(words) and abs(len(w) + len(words[i + 1]) - len(p)) <= 2 and may_be_alike(p, w + words[i + 1], least):
                best = max(best, alike(p, w + words[i + 1]))
        low = min(low, best)
        if low < least:
            return 0.0
    return low


def close_code(a: str, b: str) -> bool:
    """Postal codes that differ by one slip: a wrong, missing or added digit, or two swapped."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        differ = [i for i in range(len(a)) if a[i] != b[i]]
        return len(differ) <= 1 or (len(differ) == 2 and differ[1] == differ[0] + 1 and a[differ[0]] == b[differ[1]] and a[differ[1]] == b[differ[0]])
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


FAR, MISSING, NEAR, SAME = 0, 1, 2, 3


def link_levels(place: Place, typed: Address) -> tuple[int, int, int, int]:
    """Locality, code, street and number of a typed address against a place: 0 different, 1 missing, 2 close, 3 same.

    From the top: a missing level passes all candidates on to the next; a level that differs is borne only if the level beside it
    (code beside locality) agrees. The number is never mistyped, so it is same, missing or different.
    """
    locality = find_phrase(place.locality, typed.words, CLOSE_LOCALITY)
    level_locality = SAME if locality >= 0.95 else NEAR if locality >= CLOSE_LOCALITY else MISSING
    if not typed.codes or not place.code:
        level_code = MISSING
    elif place.code in typed.codes:
        level_code = SAME
    else:
        level_code = NEAR if any(close_code(place.code, c) for c in typed.codes) else FAR
    street = find_phrase(place.street, typed.words, CLOSE_STREET)
    level_street = SAME if street >= 0.95 else NEAR if street >= CLOSE_STREET else FAR
    level_number = SAME if place.number in typed.numbers else FAR if typed.numbers else MISSING
    return level_locality, level_code, level_street, level_number


def region_level(place: Place, typed: Address) -> int:
    """3 if a typed address names the place's region as the reference does, else 1: regions are often left out, or written short or long."""
    words = _WORD.findall(place.region)
    return SAME if words and set(words) <= set(typed.words) else MISSING


_ALL_NUMBERS = re.compile(r"(?<![\w\-/])\d[\d\-/]*(?![\w])")


def quick_levels(place: Place, folded: str) -> tuple[int, int, int, int] | None:
    """The levels against a folded address that plainly has the place's number, code, street and locality; None if it isn't plain.

    Plain is an address without a word of units or a landmark, whose only numbers are the place's, so that reading it in full
    would give the same.
    """
    if "|" in folded or "#" in folded:
        return None
    numbers = _ALL_NUMBERS.findall(folded)
    if len(numbers) > 2 or place.number not in numbers:
        return None
    others = [n for n in numbers if n != place.number]
    if others and others[0].replace("-", "") != place.code:
        return None
    words = set(_ALL_WORDS.findall(folded))
    if words & PARTS or not words.issuperset(place.street.split()) or not words.issuperset(place.locality.split()):
        return None
    return SAME, SAME if others else MISSING, SAME, SAME


def same_building(levels: tuple[int, int, int, int]) -> bool:
    """Whether the levels together tell one building: the number, the street, and the locality or its code."""
    locality, code, street, number = levels
    if number != SAME or street < NEAR:
        return False
    if code == SAME:
        return street == SAME or locality >= MISSING
    return locality >= NEAR and code != FAR or (locality == SAME and street == SAME)


def tells_building(typed: Address) -> bool:
    """Whether an address has a number and words to tell a building by."""
    return bool(typed.numbers) and any(len(w) > 3 and w not in STREET_KINDS for w in typed.words)


def typed_keys(typed: Address) -> set[str]:
    """Keys under which a typed address is sought: each number with each code and each way a street may begin and end.

    Without a code also with each word as a locality and the first sounds of each other as a street.
    """
    out = set()
    words = [w for w in typed.words if len(w) > 2 and w not in STREET_KINDS]
    sounds = [sound(w) for w in words]
    joined = [a + b for a, b in zip(typed.words, typed.words[1:], strict=False) if len(a) + len(b) > 6 and not {a, b} & STREET_KINDS]
    kinds = [f"{a} {b}" for a, b in zip(typed.words, typed.words[1:], strict=False) if a in STREET_KINDS and b in STREET_KINDS]
    for n in typed.numbers:
        out |= {f"{n}>{c}" for c in typed.codes} | {f"{n}={k}" for k in kinds}
        for s in sounds:
            out |= {f"{n}>{s[:4]}", f"{n}<{s[-5:]}"}
        out |= {f"{n}>{sound(w)[:4]}" for w in joined}
        if not typed.codes:
            out |= {f"{n}@{t[:5]}|{s[:2]}" for t in sounds for s in sounds if t is not s}
    return out


def place_keys(place: Place) -> set[str]:
    """The same keys of a place."""
    n, words = place.number, place.street.split()
    out = {f"{n}>{place.code}"} if place.code else set()
    if all(w in STREET_KINDS for w in words):
        out.add(f"{n}={place.street}")
    for w in words:
        s = sound(w)
        out |= {f"{n}>{s[:4]}", f"{n}<{s[-5:]}"}
        out |= {f"{n}@{sound(t)[:5]}|{s[:2]}" for t in place.locality.split()[:1]}
    return out


def _refined(number: str, street: str, codes: tuple[str, ...], localities: list[str]) -> set[str]:
    s = sound(street)
    out = {f"{number}>{part}|{upper}" for part in (f"{s[:4]}>", f"<{s[-5:]}") for upper in (*codes, *(f"@{t[:5]}" for t in localities))}
    return out | {f"{number}={part}|{c}" for part in (f"{s[:2]}>", f"<{s[-2:]}") for c in codes}


def refined_typed_keys(typed: Address) -> set[str]:
    """Keys for addresses one of whose keys is common: number and street within each code, and within each word as a locality."""
    words = [w for w in typed.words if len(w) > 2 and w not in STREET_KINDS]
    words += [a + b for a, b in zip(typed.words, typed.words[1:], strict=False) if len(a) + len(b) > 6]
    sounds = [sound(w) for w in words]
    streets = words or list(typed.words)
    return {k for n in typed.numbers for i, w in enumerate(streets) for k in _refined(n, w, typed.codes, [*sounds[:i], *sounds[i + 1 :]])}


def refined_place_keys(place: Place) -> set[str]:
    """The same keys of a place."""
    localities = [sound(t) for t in place.locality.split()]
    return {k for w in place.street.split() for k in _refined(place.number, w, (place.code,) if place.code else (), localities)}
