"""How alike many pairs of words, and of names, are, computed for whole batches at once."""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np

from weft.llm import names

#: Bytes of a word that one machine word of the subsequence table can stand for; pairs with a longer word are compared one by one.
WIDTH = 64
#: Words of a typed name that the tables hold; longer names are compared one by one.
MOST = 6
_PET_BITS: dict[str, int] = {}
for _bit, _group in enumerate(names.PET_FORMS.split("|")):
    for _form in _group.split():
        _PET_BITS[names.sound(_form)] = _PET_BITS.get(names.sound(_form), 0) | 1 << _bit


def matrix(words: list[bytes], width: int) -> np.ndarray:
    """The bytes of words, a row for each, filled up with zeros."""
    return np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width) if words else np.zeros((0, width), dtype=np.uint8)


def lcs_lengths(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of the rows left[a] and right[b], by bits; rows are at most WIDTH bytes wide, zeros fill them up."""
    x, y = left[a], right[b]
    width = -(-max(1, x.shape[1]) // 8) * 8
    x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    full = np.full(len(a), (1 << width) - 1, dtype=np.uint64)
    row = full.copy()
    eight = np.zeros((len(a), 8), dtype=np.uint8)
    for j in range(y.shape[1]):
        c = y[:, j]
        live = c > 0
        if not live.any():
            break
        eight[:, : width // 8] = np.packbits((x == c[:, None]) & live[:, None], axis=1, bitorder="little")
        hit = eight.view(np.uint64)[:, 0] & row
        row = ((row + hit) | (row - hit)) & full
    return width - np.bitwise_count(row).astype(np.int64)


class Words:
    """A table of different words with their sounds, by number."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.sounds = names.sounds(words)
        texts, sounds = ("\n".join(group).encode().split(b"\n") if group else [] for group in (words, self.sounds))
        self.text_length = np.fromiter(map(len, texts), dtype=np.int64, count=len(words))
        self.sound_length = np.fromiter(map(len, sounds), dtype=np.int64, count=len(words))
        self.long = np.maximum(self.text_length, self.sound_length) > WIDTH
        self.text, self.sound = (matrix(group, max(1, min(WIDTH, max(map(len, group), default=1)))) for group in (texts, sounds))
        number: dict[str, int] = {}
        self.sound_number = np.fromiter((number.setdefault(s, len(number)) for s in self.sounds), dtype=np.int64, count=len(words))
        self.pets = np.fromiter((_PET_BITS.get(s, 0) for s in self.sounds), dtype=np.uint64, count=len(words))
        self.letters = np.zeros(len(words), dtype=np.uint64)
        for j in range(self.sound.shape[1]):
            c = self.sound[:, j].astype(np.uint64)
            self.letters |= np.where(c > 0, np.uint64(1) << (c & np.uint64(63)), np.uint64(0))

    def _starts(self, table: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether word a starts with word b."""
        x, y = table[a], table[b]
        return ((x == y) | (np.arange(table.shape[1])[None, :] >= size[b][:, None])).all(axis=1) & (size[a] >= size[b])

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How well typed word b stands for full word a, as names.word_score says; what is under a half may be given as 0."""
        out = np.zeros(len(a))
        out[a == b] = 1.0
        long = self.long[a] | self.long[b]
        for i in np.nonzero(long & (a != b))[0]:
            out[i] = names.word_score(self.words[a[i]], self.words[b[i]])
        open_ = ~long & (a != b)
        same = open_ & (self.sound_number[a] == self.sound_number[b])
        # words of one sound are alike whatever their pet forms; names.word_score gives them the value of a pet form
        out[same | (open_ & ((self.pets[a] & self.pets[b]) > 0))] = 0.95
        left = np.nonzero(open_ & (out == 0))[0]
        if not len(left):
            return out
        p, q = a[left], b[left]
        la, lb = self.sound_length[p], self.sound_length[q]
        missing_a = np.bitwise_count(self.letters[p] & ~self.letters[q]).astype(np.int64)
        missing_b = np.bitwise_count(self.letters[q] & ~self.letters[p]).astype(np.int64)
        most = 2 * np.minimum(la - missing_a, lb - missing_b) / np.maximum(la + lb, 1)
        score = np.zeros(len(left))
        near = np.nonzero(most >= 0.5)[0]
        if len(near):
            ratio = 2 * lcs_lengths(self.sound, self.sound, p[near], q[near]) / np.maximum(la[near] + lb[near], 1)
            again = np.nonzero((ratio >= 0.4) & (ratio < 0.9))[0]
            if len(again):
                x, y = p[near[again]], q[near[again]]
                ratio[again] = np.maximum(ratio[again], 2 * lcs_lengths(self.text, self.text, x, y) / (self.text_length[x] + self.text_length[y]))
            score[near] = ratio
        short = np.nonzero((lb >= 3) & (lb < la))[0]
        if len(short):
            x, y = p[short], q[short]
            begins = self._starts(self.sound, self.sound_length, x, y) | self._starts(self.text, self.text_length, x, y)
            value = np.where((lb[short] >= 4) | (self.text_length[y] >= 4), 0.9, 0.8)
            score[short] = np.where(begins, np.maximum(score[short], value), score[short])
            # a truncated word with a slip in it
            cut = short[~begins & (lb[short] >= 5) & (self.text_length[y] + 2 < self.text_length[x]) & (self.text[x, 0] == self.text[y, 0])]
            if len(cut):
                x, y = p[cut], q[cut]
                begin = self.text[x].copy()
                begin[np.arange(begin.shape[1])[None, :] >= self.text_length[y][:, None]] = 0
                score[cut] = np.maximum(score[cut], 0.9 * lcs_lengths(begin, self.text[y], np.arange(len(cut)), np.arange(len(cut))) / self.text_length[y])
        first = (self.text_length[q] == 1) & (self.text[p, 0] == self.text[q, 0])
        out[left] = np.where(first, np.maximum(score, names.INITIAL), score)
        return out

    def losses(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Letters of words that may be lost to sounds, and whether the sound of a part may differ from the part of the sound where it was cut."""
        pairs = [(self.words[i], self.sounds[i]) for i in numbers.tolist()]
        lost = np.array([len(w) - len(s) + w.count("x") for w, s in pairs], dtype=np.float32)
        return lost, np.array([float(n > 0 or "x" in w or "h" in w or not w.isascii()) for (w, _), n in zip(pairs, lost.tolist(), strict=True)], dtype=np.float32)

    def parts(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """False where surely no part of word q, about as long as word p, is so like it that their names can match."""
        different, back = np.unique(q, return_inverse=True)
        lost, slack = self.losses(different)
        text, sound = part_of(self.text_length[p].astype(np.float32), self.sound_length[p].astype(np.float32), lost[back], slack[back])
        out = self.long[p] | self.long[q] | (lcs_lengths(self.text, self.text, p, q) >= text)
        out[~out] = lcs_lengths(self.sound, self.sound, p[~out], q[~out]) >= sound[~out]
        return out


def _bags(letters: np.ndarray) -> np.ndarray:
    """Of each row of bytes numbers whose inner product with another row's is at least the length of any common subsequence.

    Bytes count in 32 groups, a first and a second time each, and further times in 8 groups.
    """
    count = np.zeros((len(letters), 32), dtype=np.int64)
    for j in range(letters.shape[1]):
        at = np.nonzero(letters[:, j])[0]
        count[at, letters[at, j] & 31] += 1
    more = np.maximum(count - 2, 0).reshape(-1, 4, 8).sum(axis=1)
    return np.concatenate([count > 0, count > 1, more], axis=1).astype(np.float32)


#: The least score of a telling word with which names match (names.matches), and a margin for rounded numbers.
LEAST_MAIN, MARGIN = 0.8, 1e-3


def part_of(text: np.ndarray, sound: np.ndarray, lost: np.ndarray, slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How long common subsequences, of letters and of sounds, are at least if a part of another word, about as long as a word of these lengths, is like it."""
    half = np.float32(LEAST_MAIN / 2)
    return half * (2 * text - 1) - MARGIN, half * (sound + text - 1 - lost) - slack - MARGIN


class Telling:
    """Which typed words, alone or with neighbours, may stand for which telling words so well that their names can match."""

    def __init__(self, words: list[str]) -> None:
        self.table = Words(words)
        self.sound, self.text = _bags(self.table.sound), _bags(self.table.text)
        self.sound_length, self.text_length = self.table.sound_length.astype(np.float32), self.table.text_length.astype(np.float32)
        self.first = np.array([ord(w[0]) & 63 if w else 0 for w in words], dtype=np.uint64)
        self.lost, self.slack = self.table.losses(np.arange(len(words)))

    def may_fit(self, told: np.ndarray, starts: np.ndarray, options: np.ndarray, single: np.ndarray, cells: int = 1 << 21) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in told and in options (numbers of words) of the pairs that bounds by letters, as products of matrices, leave; the others surely don't fit.

        Third, whether the option may be two words written as one. starts: bits of the first letters of the words of each told one's name, 0
        for a name of one word. single: whether an option is one word.
        """
        step = max(1, cells // max(1, len(told)))
        found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool))]
        for i in range(0, len(options), step):
            a, b, glued = self._block(told, starts, options[i : i + step], single[i : i + step])
            found.append((a, b + i, glued))
        return tuple(np.concatenate(part) for part in zip(*found, strict=True))

    def fit(self, told: np.ndarray, options: np.ndarray, glued: np.ndarray) -> np.ndarray:
        """Of pairs of words that `may_fit` left whether they do, by their scores."""
        out, table = np.zeros(len(told), dtype=bool), self.table
        keys, back = np.unique(told * len(table.words) + options, return_inverse=True)
        whole = np.zeros(len(keys), dtype=bool)
        whole[back[~glued]] = True
        p, q = keys // len(table.words), keys % len(table.words)
        good, part = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
        good[whole] = table.scores(p[whole], q[whole]) >= LEAST_MAIN - MARGIN
        part[back[glued]] = True
        p, q = p[part], q[part]
        part[part] = table.parts(p, q)
        out[:] = np.where(glued, part[back], good[back])
        return out

    def _part_of(self, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return part_of(self.text_length[p], self.sound_length[p], self.lost[q], self.slack[q])

    def _block(self, told: np.ndarray, starts: np.ndarray, options: np.ndarray, single: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = self.table
        sa, sb, ta, tb = self.sound_length[told][:, None], self.sound_length[options], self.text_length[told][:, None], self.text_length[options]
        by_sound, by_text = self.sound[told] @ self.sound[options].T, self.text[told] @ self.text[options].T
        half = np.float32(LEAST_MAIN / 2)
        # a shorter word may be a beginning, with a slip in it
        may = (by_sound >= np.minimum(half * (sa + sb), sb) - MARGIN) | (by_text >= np.minimum(half * (ta + tb), np.float32(LEAST_MAIN / 0.9) * tb) - MARGIN)
        pets_a, pets_b, long_a, long_b = table.pets[told], table.pets[options], table.long[told], table.long[options]
        if pets_a.any() and pets_b.any():
            may |= (pets_a[:, None] & pets_b) > 0
        if long_a.any() or long_b.any():
            may |= long_a[:, None] | long_b
        if not single.all():
            may &= single | (np.abs(ta - tb) <= 2)
        a, b = np.nonzero(may)
        # what is too short for a likeness must begin as the telling word does, by letters or by sounds
        p, q = told[a], options[b]
        near = (self.first[p] == self.first[q]) | (table.sound[p, 0] == table.sound[q, 0])
        near |= (by_sound[a, b] >= half * (self.sound_length[p] + self.sound_length[q]) - MARGIN) | (by_text[a, b] >= half * (self.text_length[p] + self.text_length[q]) - MARGIN)
        near |= ((table.pets[p] & table.pets[q]) > 0) | table.long[p] | table.long[q]
        a, b = a[near], b[near]
        # a long word may be two written as one, of which a part about as long as the telling word is like it
        wide = np.nonzero(single & (tb > ta.min(initial=np.inf) + 2))[0] if starts.any() else a[:0]
        x, y = np.nonzero(tb[wide] > ta + 2)
        y = wide[y]
        begun = ((starts[x] >> self.first[options[y]]) & np.uint64(1)) > 0
        x, y = x[begun], y[begun]
        text, sound = self._part_of(told[x], options[y])
        kept = (by_text[x, y] >= text) | (by_sound[x, y] >= sound) | table.long[told[x]] | table.long[options[y]]
        x, y = x[kept], y[kept]
        return np.concatenate([a, x]), np.concatenate([b, y]), np.repeat([False, True], [len(a), len(x)])


@lru_cache(maxsize=100_000)
def trade_score(reference: tuple[str, ...], typed: tuple[str, ...]) -> float:
    return names.compare_trades(reference, typed)


def compare_names(reference: list[str], typed: list[str]) -> np.ndarray:
    """names.compare of each pair of name texts: a row of main, second, trade and left for each.

    Names of at most two reference words and MOST typed ones are compared by tables; the few others, and typed words that may be two
    written as one, one by one.
    """
    def distinct(texts: list[str]) -> tuple[np.ndarray, list[list[str]], list[list[str]]]:
        """Of each text the number of its reading, and of each reading the words of its core and of its trade."""
        place: dict[str, int] = {}
        at = np.fromiter((place.setdefault(t, len(place)) for t in texts), dtype=np.int64, count=len(texts))
        parts = [t.split("|") for t in place]
        return at, [p[0].split() for p in parts], [p[1] for p in parts]

    ra, cores, trades_r = distinct(reference)
    tb, typed_cores, trades_t = distinct(typed)
    out = np.zeros((len(reference), 4))
    if not len(ra):
        return out
    simple_r = np.array([1 <= len(c) <= 2 for c in cores])
    simple_t = np.array([1 <= len(c) <= MOST for c in typed_cores])
    simple = simple_r[ra] & simple_t[tb]
    pairs = np.nonzero(simple)[0]
    # options of typed names: a word, or neighbours written as one, with its first and last word
    listed = [list(names.options(c)) if s else [] for c, s in zip(typed_cores, simple_t, strict=True)]
    sizes = np.fromiter(map(len, listed), dtype=np.int64, count=len(listed))
    texts, firsts, lasts = zip(*chain.from_iterable(listed), strict=True) if sizes.sum() else ((), (), ())
    firsts, lasts = np.array(firsts, dtype=np.int64), np.array(lasts, dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    each = sizes[tb[pairs]]
    row = np.repeat(np.arange(len(pairs)), each)
    option = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(begins[tb[pairs]], each)
    first, last = firsts[option], lasts[option]
    single = first == last
    lengths = np.array([[len(w) for w in c[:MOST]] + [0] * (MOST - len(c[:MOST])) for c in typed_cores], dtype=np.int64).reshape(-1, MOST)
    # joined words are looked at only where they are about as long as a word of the reference's
    option_size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))[option]
    telling_size = np.array([len(c[0]) if c else 0 for c in cores], dtype=np.int64)[ra[pairs]][row]
    other_size = np.array([len(c[1]) if len(c) == 2 else -9 for c in cores], dtype=np.int64)[ra[pairs]][row]
    fits = single | (np.abs(option_size - telling_size) <= 2)
    fits_other = single | (np.abs(option_size - other_size) <= 2)
    number: dict[str, int] = {}
    used = np.unique(option[fits | fits_other])
    word_at = np.full(len(texts), -1, dtype=np.int64)
    word_at[used] = [number.setdefault(texts[i], len(number)) for i in used.tolist()]
    main = np.array([number.setdefault(c[0], len(number)) if s else 0 for c, s in zip(cores, simple_r, strict=True)], dtype=np.int64)
    rest = np.array([number.setdefault(c[1], len(number)) if len(c) == 2 else -1 for c in cores], dtype=np.int64)
    table = Words(list(number))
    word_of = word_at[option]
    size = table.text_length

    def score(full: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Scores of options for a reference word each, by distinct pairs of words."""
        found = np.zeros(len(full))
        at = np.nonzero(mask)[0]
        keys, back = np.unique(full[at] * len(table.words) + word_of[at], return_inverse=True)
        found[at] = table.scores(keys // len(table.words), keys % len(table.words))[back]
        return found

    def best(values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair the highest value and its first option; rows are in order and each pair has one."""
        starts = np.cumsum(each) - each
        high = np.maximum.reduceat(values, starts) if count else np.zeros(0)
        hit = np.nonzero(values == high[row])[0]
        where = np.full(count, -1, dtype=np.int64)
        where[row[hit][::-1]] = hit[::-1]
        return high, where

    told = main[ra[pairs]][row]
    # a word of one or two letters counts only as the very telling word
    able = fits & ((option_size >= 3) | (single & (word_of == told)))
    likely = (2 * np.minimum(size[told], size[word_of]) >= 0.7 * (size[told] + size[word_of])) | (size[word_of] < size[told])
    high, where = best(score(told, able & likely), len(pairs))
    one_by_one = np.zeros(len(pairs), dtype=bool)
    if len(pairs):
        other = rest[ra[pairs]]
        # a long typed word that isn't the telling one may be two written as one
        letter = table.text[:, 0]
        glued = able & single & (size[word_of] > size[told] + 2) & (high[row] < 0.9) & (other[row] >= 0)
        glued &= (letter[word_of] == letter[told]) | (letter[word_of] == letter[other[row].clip(0)])
        open_ = np.nonzero(glued)[0]
        one_by_one[row[open_[table.parts(told[open_], word_of[open_])]]] = True
        start, end = first[where], last[where]
        free = (last < start[row]) | (first > end[row])
        left_letters = lengths[tb[pairs]].copy()
        column = np.arange(MOST)[None, :]
        left_letters[(column >= start[:, None]) & (column <= end[:, None])] = 0
        any_left = left_letters.sum(axis=1) > 0
        asked = (other >= 0) & any_left & (high >= 0.5)
        values = score(other[row].clip(0), free & asked[row] & fits_other)
        values[~(free & fits_other)] = -1.0
        second, chosen = best(values, len(pairs))
        gone = asked & (second >= 0.55)
        used = gone[:, None] & (column >= first[chosen][:, None]) & (column <= last[chosen][:, None])
        left_letters[used] = 0
        second = np.where(asked, np.maximum(second, 0.0), -1.0)
        left = left_letters.sum(axis=1) / np.maximum(lengths[tb[pairs]].sum(axis=1), 1)
        known: dict[str, int] = {}
        trade_r, trade_t = (np.array([known.setdefault(t, len(known)) for t in group], dtype=np.int64) for group in (trades_r, trades_t))
        trade_words = [tuple(t.split()) for t in known]
        keys, back = np.unique(trade_r[ra[pairs]] * len(known) + trade_t[tb[pairs]], return_inverse=True)
        trades = np.array([trade_score(trade_words[k // len(known)], trade_words[k % len(known)]) for k in keys.tolist()])[back]
        weak = high < 0.5
        out[pairs] = np.stack([high, np.where(weak, -1.0, second), np.where(weak, -1.0, trades), np.where(weak, 1.0, left)], axis=1)
    for i in chain(pairs[one_by_one], np.nonzero(~simple)[0]):
        out[i] = names.compare(names.from_text(reference[i]), names.from_text(typed[i]))
    return out


def matching(scores: np.ndarray) -> np.ndarray:
    """names.matches of each row of scores."""
    main, second, trade, left = scores.T
    trades = (trade < 0) | (trade >= 0.5)
    without = (second < 0) & (main >= 0.9) & (left <= 0.25) & trades
    whole = (second >= 0.75) & (left <= 0.45) & ((main >= 0.9) | ((main >= 0.82) & trades) | ((main >= 0.8) & (trade >= 0.9)))
    part = (second >= 0) & (second < 0.75) & (left <= 0.3) & trades & (((second == names.INITIAL) & (main >= 0.88)) | ((second >= 0.68) & (main >= 0.92)))
    return without | whole | part


def strengths(scores: np.ndarray) -> np.ndarray:
    """names.strength of each row of scores."""
    main, second, trade, left = scores.T
    return main + np.maximum(second, 0.5) + 0.3 * np.maximum(trade, 0.5) - left
