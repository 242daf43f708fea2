"""Toxicity: noisy-channel deobfuscation, then scores of the restored text.

Each word's core is read as a noisy spelling: a lattice gives every character
the letters it may stand for (itself, a letter of the same shape), lets runs
of a letter shrink and lets separators inside a word vanish. Symbols at a
word's ends may be letters or not: the word is read with and without them.
Neighbouring words of one or two letters may be one word (spaced-out spelling),
also with signs between them: every window of them is read that may be as long
as a mark, so that real short words beside it do not hide it. Viterbi search
finds the restored spelling that is likeliest under a letter bigram model and
the channel's costs. Plain words (letters only, no letter three times in a
row) have a lattice of one path, and one more for each doubled letter that may
be a single one. Two or three neighbouring words that join to a word which only
toxic training texts have are read as that word. Time is linear in a word's
length: of symbols at a word's end the nearest ``EDGE`` changes count, and a run
of one character counts as three.

The restored text is scored by marks, words and word beginnings that are
evidence of toxicity in the training texts; a text's score is the chance
that at least one of its distinct marks holds (noisy or). Marks are learned
from every labelled training text, whole (repeated ids once); copies count once,
so that a copied text does not make marks of all its words. Letters, groups of
copies and the groups that hold a feature are Spark aggregates (``trained``);
``fit`` is the same for rows in memory. Null and empty texts get the prior.
"""

from __future__ import annotations

import math
import pickle
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Container, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pushback.llm import simhash
from pushback.llm.common import labelled_ids, labelled_texts, map_rows
from pushback.session import cut_lineage, drop_stage

THRESHOLD = 0.3
#: Letters that digits and symbols are drawn for.
SHAPES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "gq",
          "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
SEPARATORS = set(".-_*~'’·/\\,:;()[]{}<>")
#: Channel costs (negative natural logarithms).
DRAWN, DROPPED, SHRUNK = 1.0, 0.5, 0.7
#: Letters of the pieces of a spaced-out word, fewest pieces, and most in a window (whole runs are read too).
PIECE, PIECES, WINDOW = 2, 3, 24
#: Lengths of word beginnings that may be marks.
STEMS = (4, 5, 6)
PRIOR = 0.02
#: Text is scored in portions of about so many characters (a longer text is one).
PORTION_CHARS = 2_000_000
#: Windows whose marks are remembered at a time.
KNOWN_WINDOWS = 200_000
DOUBLE = re.compile(r"([^\w\s]|\d)\1")
RUN = re.compile(r"(.)\1\1")
LONG_RUN = re.compile(r"(.)\1{3,}", re.S)
TWICE = re.compile(r"(.)\1")
SAME = re.compile(r"(.)\1+", re.S)
LEADING = re.compile(r"[^\W\d_]+")
#: Changes of symbol at a word's end at which it may begin or stop.
EDGE = 6
#: Fewest letters of a word that may be split.
SPLIT = 5
#: Minimum hashes of a text, and words of a shingle.
HASHES, SHINGLE = 4, 4
#: Features that clean texts are searched for at a time (more: another pass).
CANDIDATES = 500_000
#: One in so many clean texts is searched first: what it holds too often need not be looked for in the others.
FIRST = 16
#: Pairs of text and feature from which the last marks are chosen in memory.
COVER_PAIRS = 1_000_000
#: Words whose features are remembered at a time.
READ_WORDS = 50_000
#: Groups of copies that are broadcast to their texts.
BROADCAST_GROUPS = 1_000_000


@dataclass
class Letters:
    """Letter bigram model with add-half smoothing; '' is a word's edge."""

    pairs: dict[tuple[str, str], int]
    singles: dict[str, int]
    alphabet: int

    def cost(self, a: str, b: str) -> float:
        return -math.log((self.pairs.get((a, b), 0) + 0.5) / (self.singles.get(a, 0) + 0.5 * self.alphabet))


def letter_pairs(counts: dict[str, int], pairs: Counter) -> None:
    """Add the letter pairs of counted words to ``pairs``."""
    for w, n in counts.items():
        if w.isalpha():
            for a, b in zip(("", *w), (*w, "")):
                pairs[a, b] += n


def fit_letters(words: Iterable[str]) -> Letters:
    pairs: Counter = Counter()
    letter_pairs(Counter(words), pairs)
    return letters_of(pairs)


def letters_of(pairs: dict[tuple[str, str], int]) -> Letters:
    singles: Counter = Counter()
    for (a, _), n in pairs.items():
        singles[a] += n
    return Letters(dict(pairs), dict(singles), len(singles) + 1)


def core(word: str) -> str:
    """The word in lower case without symbols around it that stand for no letter."""
    low = word.lower()
    if low.isalpha():
        return low
    start, stop = 0, len(low)
    while start < stop and not (low[start].isalnum() or low[start] in "@$"):
        start += 1
    while stop > start and not low[stop - 1].isalnum():
        stop -= 1
    return low[start:stop]


def noisy(word: str) -> bool:
    """A core with something to decode: shapes, separators or long runs."""
    if not word.isalpha():
        return any(c.isalpha() for c in word)
    return RUN.search(word) is not None


def bare(word: str) -> str:
    """The word in lower case without symbols around it that are drawn for no letter."""
    low = word.lower()
    start, stop = 0, len(low)
    while start < stop and not (low[start].isalnum() or low[start] in SHAPES):
        start += 1
    while stop > start and not (low[stop - 1].isalnum() or low[stop - 1] in SHAPES):
        stop -= 1
    return low[start:stop]


def spellings(word: str) -> list[tuple[str, list[int]]]:
    """Parts of a word that may be its spelling, by start, each with the
    lengths to read: symbols at both ends count or not, equal ones together."""
    whole = bare(word)
    first = next((i for i, c in enumerate(whole) if c.isalnum()), len(whole))
    last = next((i for i in range(len(whole), 0, -1) if whole[i - 1].isalnum()), 0)
    if first >= last:
        return []
    starts = [i for i in range(first + 1) if i in (0, first) or whole[i] != whole[i - 1]]
    stops = [i for i in range(last, len(whole) + 1) if i in (last, len(whole)) or whole[i] != whole[i - 1]]
    starts, stops = [*starts[:1], *starts[1:][-EDGE:]], [*stops[:-1][:EDGE], stops[-1]]
    return [(whole[i:], [j - i for j in stops]) for i in starts]


def restore(word: str, letters: Letters) -> str:
    """Viterbi decoding of one noisy core."""
    return restores(word, letters, [len(word)])[0]


def restores(word: str, letters: Letters, stops: list[int], shrunk: bool = True) -> list[str]:
    """Viterbi decoding of a noisy spelling up to each of the lengths, in one pass."""
    out: list[str] = []
    best: dict[str, tuple[float, tuple | None]] = {"": (0.0, None)}  # by last letter: cost, (text before, letter)
    ends = set(stops)
    for i, c in enumerate(word):
        choices = [(c, 0.0)] if c.isalpha() else [(x, DRAWN) for x in SHAPES.get(c, "")]
        step: dict[str, tuple[float, tuple | None]] = {}
        for last, (cost, text) in best.items():
            if (not choices or c in SEPARATORS) and (last not in step or cost + DROPPED < step[last][0]):
                step[last] = (cost + DROPPED, text)
            if shrunk and i and c == word[i - 1] and last and (last not in step or cost + SHRUNK < step[last][0]):
                step[last] = (cost + SHRUNK, text)
            for letter, extra in choices:
                total = cost + extra + letters.cost(last, letter)
                if letter not in step or total < step[letter][0]:
                    step[letter] = (total, (text, letter))
        best = step or best
        if i + 1 in ends:
            _, _, text = min((cost + letters.cost(last, ""), last, text) for last, (cost, text) in best.items())
            found = []
            while text is not None:
                text, letter = text
                found.append(letter)
            out.append("".join(reversed(found)))
    return out


def undoubled(word: str) -> list[str]:
    """Readings of a word in which a doubled letter, or each of them, is a single one."""
    at = [m.start() for m in TWICE.finditer(word)]
    out = [word[:i] + word[i + 1:] for i in at]
    return [*out, TWICE.sub(r"\1", word)] if len(at) > 1 else out


def shrink(word: str) -> list[str]:
    """Further readings of a core with long runs: each run as one or two letters."""
    runs: list[list] = []
    for c in word:
        if runs and runs[-1][0] == c:
            runs[-1][1] += 1
        else:
            runs.append([c, 1])
    return ["".join(c * min(n, 1 if n > 2 else n) for c, n in runs), "".join(c * min(n, 2) for c, n in runs)]


def readings(word: str, letters: Letters) -> list[str]:
    """Restored spellings of one word of a text."""
    plain = core(word)
    if plain.isalpha() and len(plain) == len(word):
        if TWICE.search(plain) is None:
            return [plain]
        if not noisy(plain):
            return [plain, *undoubled(plain)]
        plain = LONG_RUN.sub(r"\1\1\1", plain)
        return list(dict.fromkeys([restore(plain, letters), *shrink(plain)]))
    if plain.isalpha() and RUN.search(word) is None and plain == bare(word):  # letters, with signs around them
        return [plain]
    word = LONG_RUN.sub(r"\1\1\1", word)
    plain = core(word)
    out: dict[str, None] = {}
    for part, stops in [(plain, [len(plain)])] * bool(plain) + spellings(word):
        hard = [n for n in stops if noisy(part[:n])]
        found = dict(zip(hard, restores(part, letters, hard))) if hard else {}
        for n in stops:
            cut = part[:n]
            for reading in (found.get(n, cut), *(shrink(cut) if n in found and cut.isalpha() else ())):
                out[reading] = None
        if hard and DOUBLE.search(part):  # a doubled symbol may be a doubled letter
            out.update(dict.fromkeys(restores(part, letters, hard, shrunk=False)))
    return list(out)


def spaced(words: list[str], window: int = WINDOW) -> Iterator[str]:
    """Windows of at most ``window`` letters of neighbouring short words, each
    joined; words of signs alone between them are passed over."""
    n = len(words)
    plain = np.fromiter(map(str.isalpha, words), bool, n) & (np.fromiter(map(len, words), np.int64, n) > PIECE)
    at = np.flatnonzero(~plain)  # the others are too long for a piece
    gaps = np.flatnonzero(np.diff(at, prepend=-2, append=n + 1) > 1)
    first, last = at[gaps[:-1]], at[gaps[1:] - 1]
    wide = last - first + 1 >= PIECES
    for i, j in zip(first[wide].tolist(), last[wide].tolist()):
        yield from _windows(words[i:j + 1], window)


def _windows(words: list[str], window: int) -> Iterator[str]:
    run: list[str] = []
    for w in [*words, ""]:
        # else the word is too long for a piece
        if len(w) <= PIECE or not (w[0].isalpha() and (w[-1].isalpha() or w[:PIECE + 1].isalpha())):
            piece = bare(w)
            if w and not piece and len(w) == 1:
                continue
            if 0 < len(piece) <= PIECE and all(c.isalpha() or c in SHAPES for c in piece):
                run.append(piece)
                continue
        if not run:
            continue
        for i in range(len(run) - PIECES + 1):
            text = "".join(run[i:i + PIECES - 1])
            for more in run[i + PIECES - 1:i + window]:
                text += more
                if len(text) > window:
                    break
                yield text
        run = []


def beginnings(names: Iterable[str]) -> frozenset[str]:
    """What a word may begin with, the word itself apart."""
    return frozenset(n[:i] for n in names for i in range(1, len(n)))


def rejoined(words: list[str], names: Container[str], heads: Container[str]) -> Iterator[str]:
    """Words of ``names``, whose beginnings are ``heads``, that two or three
    neighbouring words (in lower case) are the parts of."""
    for i in [i for i, w in enumerate(words) if w in heads]:
        text = words[i]
        for w in words[i + 1:i + 3]:
            text += bare(w)
            if text in names:
                yield text
            if text not in heads:
                break


def features(reading: str) -> list[str]:
    """The word and its beginnings, shortest last."""
    return ["=" + reading, *("^" + reading[:n] for n in reversed(STEMS) if len(reading) > n)]


@dataclass
class Model:
    marks: dict[str, float]
    letters: Letters
    prior: float = PRIOR
    names: frozenset[str] = frozenset()  # whole words with a mark that only toxic texts have

    @property
    def window(self) -> int:
        """Letters that the spelling of a mark may have: each twice, as far as marks are long."""
        return 2 * max((len(f) for f in self.marks), default=0)

    @cached_property
    def heads(self) -> tuple[int, frozenset[str]]:
        """How marks begin, each letter once in a row: the length and the beginnings."""
        single = [SAME.sub(r"\1", f[1:]) for f in self.marks]
        size = min((min(len(s), STEMS[0]) for s in single), default=0)
        return size, frozenset(s[:size] for s in single)

    @cached_property
    def firsts(self) -> frozenset[str]:
        """First letters of marks."""
        return frozenset(h[:1] for h in self.heads[1])

    def may_hold(self, word: str) -> bool:
        """False if the word begins with letters, or is of letters with signs around
        them, and begins like no mark: its readings keep the letters that it begins
        with, apart from repeated ones."""
        low = word.lower()
        size, heads = self.heads
        if size and low[:1] not in self.firsts and low[:1].isalpha():
            return False
        if not low.isalpha():
            start = LEADING.match(low)
            if size and start and start[0].isalpha() and len(single := SAME.sub(r"\1", start[0])) >= size:
                return single[:size] in heads
            low = bare(word)
            if not low.isalpha():
                return True
        return (SAME.sub(r"\1", low) if TWICE.search(low) else low)[:size] in heads

    def mark(self, word: str) -> tuple[str, float] | None:
        """The strongest mark of a word with the chance that it holds."""
        if not self.may_hold(word):
            return None
        found = None
        for reading in readings(word, self.letters):
            for f in features(reading):
                p = self.marks.get(f)
                if p is not None and (found is None or p > found[1]):
                    found = (f, p)
        return found

    def scores(self, texts: Iterable[str | None]) -> list[float]:
        """Scores of texts; each distinct word of a portion is read once."""
        out: list[float] = []
        held: list[tuple[set[str], dict[str, float]]] = []
        joined: dict[str, tuple[str, float] | None] = {}
        size, window, heads = 0, self.window, beginnings(self.names)
        for t in texts:
            words = t.split() if t else []
            hits: dict[str, float] = {}
            for w in (*spaced(words, window), *rejoined(t.lower().split() if t else [], self.names, heads)):
                if w not in joined:
                    if len(joined) >= KNOWN_WINDOWS:
                        joined.clear()
                    joined[w] = self.mark(w)
                if joined[w] is not None:
                    hits.update([joined[w]])
            held.append((set(words), hits))
            size += len(t or "")
            if size >= PORTION_CHARS:
                out.extend(self._portion(held))
                held, size = [], 0
        out.extend(self._portion(held))
        return out

    def _portion(self, texts: list[tuple[set[str], dict[str, float]]]) -> list[float]:
        hits = {w: hit for w in set().union(*(d for d, _ in texts)) if (hit := self.mark(w)) is not None}
        out = []
        for distinct, joined in texts:
            miss = 1.0 - self.prior
            for p in (joined | dict(hits[w] for w in distinct & hits.keys())).values():
                miss *= 1.0 - p
            out.append(1.0 - miss)
        return out


def minimum_hashes(words: list[str]) -> list[int]:
    """A few minimum hashes of a text's shingles."""
    raw = [w.encode() for w in words]
    parts = map(b" ".join, zip(*(raw[i:] for i in range(SHINGLE)))) if len(raw) > SHINGLE else [b" ".join(raw)]
    base = np.fromiter(map(zlib.crc32, parts), dtype=np.uint64)
    return [int(((base * np.uint64(2 * k + 2654435761) + np.uint64(k * 40503)) % np.uint64(4294967291)).min())
            for k in range(HASHES)]


def copy_groups(word_lists: list[list[str]]) -> list[int]:
    """Group of each text: texts that share one of a few minimum hashes of
    their shingles belong together."""
    parent = list(range(len(word_lists)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen: dict[tuple[int, int], int] = {}
    for i, words in enumerate(word_lists):
        for k, low in enumerate(minimum_hashes(words)):
            j = seen.setdefault((k, low), i)
            parent[find(i)] = find(j)
    return [find(i) for i in range(len(word_lists))]


class Readings:
    """Features of the readings of words, those of ``of`` alone if it is given; a bounded number is remembered."""

    def __init__(self, letters: Letters, of: Container[str] | None = None):
        self.letters, self.of = letters, of
        self.memory: dict[str, tuple[str, ...]] = {}

    def word(self, w: str) -> tuple[str, ...]:
        found = self.memory.get(w)
        if found is None:
            if len(self.memory) >= READ_WORDS:
                self.memory.clear()
            every = dict.fromkeys(f for r in readings(w, self.letters) for f in features(r))
            found = self.memory[w] = tuple(f for f in every if self.of is None or f in self.of)
        return found

    def text(self, words: list[str]) -> set[str]:
        return {f for w in {*words, *spaced(words)} for f in self.word(w)}


@dataclass
class Evidence:
    """What the groups of toxic (t) and of clean (c) texts that hold a feature
    tell of it, given how many there are and how many features were tried."""

    toxic: int
    clean: int
    tried: int

    @property
    def weight(self) -> float:
        return max(1.0, self.toxic / max(1, self.clean))

    def telling(self, t, c):
        """Whether it is a mark (numbers or columns); more clean groups never make it one."""
        bits = -math.log2(self.toxic / (self.toxic + self.clean + 1))
        need = math.log2(self.tried + 1) + 7
        return (t / (t + c * self.weight + 0.5) >= 0.8) & ((t - 4 * c) * bits >= need)

    def chance(self, t: int, c: int) -> float:
        return min(0.995, (t + 0.3) / (t + self.weight * c + 0.5))


def covering(left: list[set[str]]) -> Iterator[str]:
    """The feature that most texts hold, again and again, while two hold one."""
    holders: dict[str, set[int]] = defaultdict(set)
    for i, own in enumerate(left):
        for f in own:
            holders[f].add(i)
    while holders:
        f, held = max(holders.items(), key=lambda x: (len(x[1]), -len(x[0]), x[0]))
        if len(held) < 2:
            break
        yield f
        done = set(held)
        for g in {g for i in done for g in left[i] if g in holders}:
            holders[g] -= done
            if not holders[g]:
                del holders[g]


def longer_marks(strong: dict[str, tuple[int, int]]) -> dict[str, list[str]]:
    """Beginnings seen in clean texts, with the longer marks that are seen in fewer."""
    return {f: [g for g, (_, d) in strong.items() if len(g) > len(f) and g[1:].startswith(f[1:]) and d < c]
            for f, (_, c) in strong.items() if f[0] == "^" and c}


def needed(strong: Iterable[str]) -> set[str]:
    """Marks that no shorter one covers."""
    strong = set(strong)
    return {f for f in strong if not any("^" + f[1:1 + n] in strong for n in STEMS if n < len(f) - 1)}


def marked_cores(words: Iterable[str], kept: set[str]) -> set[str]:
    """Whole words with a mark that may be split."""
    return {c for w in words if len(c := core(w)) >= SPLIT and c.isalpha() and not kept.isdisjoint(features(c))}


def fit(sample: list[tuple[str, int]]) -> Model:
    """Letters and marks of (text, toxic) rows in memory."""
    lists = [t.split() for t, _ in sample]
    letters = fit_letters(core(w) for words in lists for w in words)
    groups = copy_groups(lists)
    toxic_groups = {g for g, (_, y) in zip(groups, sample) if y}
    clean_groups = {g for g, (_, y) in zip(groups, sample) if not y}
    if not toxic_groups:
        return Model({}, letters)
    read = Readings(letters)
    texts = [read.text(words) for words, (_, y) in zip(lists, sample) if y]
    toxic: dict[str, set[int]] = defaultdict(set)  # feature -> groups of toxic texts
    for own, g in zip(texts, (g for g, (_, y) in zip(groups, sample) if y)):
        for f in own:
            toxic[f].add(g)
    evidence = Evidence(len(toxic_groups), len(clean_groups), len(toxic))
    toxic = {f: gs for f, gs in toxic.items() if len(gs) > 1}
    clean: dict[str, set[int]] = {f: set() for f in toxic}
    read = Readings(letters, toxic)
    for words, g, (_, y) in zip(lists, groups, sample):
        if not y:
            for f in read.text(words):
                clean[f].add(g)
    counts = {f: (len(gs), len(clean[f])) for f, gs in toxic.items()}
    strong = {f: n for f, n in counts.items() if evidence.telling(*n)}
    # texts without a strong mark: the mark that explains most of them, again and again
    left = [{f for f in own if f in counts and not counts[f][1]} for own in texts if not own & strong.keys()]
    strong.update((f, counts[f]) for f in list(covering(left)))
    # a beginning seen in clean texts yields to longer marks that cover it and are not
    for f, longer in longer_marks(strong).items():
        if len(set().union(*(toxic[g] for g in longer))) >= 0.9 * len(toxic[f]):
            del strong[f]
    # a word or longer beginning that a shorter mark covers adds nothing
    kept = needed(strong)
    names = set().union(*(marked_cores(set(words), kept) for words, (_, y) in zip(lists, sample) if y))
    names -= {core(w) for words, (_, y) in zip(lists, sample) if not y for w in set(words)}
    return Model({f: evidence.chance(*strong[f]) for f in kept}, letters, names=frozenset(names))


@lru_cache(maxsize=2)
def _loaded(blob: bytes) -> Model:
    return pickle.loads(blob)


def scorer(model: Model):
    """Column expression of a text column's score; each worker keeps one model."""
    blob = pickle.dumps(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(_loaded(blob).scores(texts), dtype="float64")

    return score


_PRINTS = [f"l{k}" for k in range(HASHES)]


def training_texts(docs: DataFrame, labels: DataFrame, *, train: Column, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(tid, text, y, l0...) of every labelled training text with its minimum hashes, written."""
    known = labelled_ids(docs, labels, label="toxic", train=train, id_col=id_col)
    texts = (labelled_texts(docs, known, id_col=id_col, text_col=text_col)
             .select(F.xxhash64("_id").alias("tid"), "text", F.col("_y").alias("y")))

    def prints(rows):
        for tid, text, y in rows:
            yield (tid, text, y, *minimum_hashes(text.split()))

    schema = T.StructType([*texts.schema.fields, *(T.StructField(c, T.LongType()) for c in _PRINTS)])
    return cut_lineage(map_rows(texts, prints, schema), "toxicity_texts")


def counted_letters(texts: DataFrame) -> Letters:
    """Letter model of all words of the texts."""
    def pairs(rows):
        found: Counter = Counter()
        words: Counter = Counter()
        for (text,) in rows:
            words.update(text.split())
            if len(words) >= KNOWN_WINDOWS:
                letter_pairs(_cores(words), found)
                words.clear()
        letter_pairs(_cores(words), found)
        yield from ((a, b, n) for (a, b), n in found.items())

    counts = (map_rows(texts.select("text"), pairs, T.StructType.fromDDL("a string, b string, n long"))
              .groupBy("a", "b").agg(F.sum("n").alias("n")))
    return letters_of({(r["a"], r["b"]): r["n"] for r in counts.collect()})


def _cores(words: Counter) -> Counter:
    out: Counter = Counter()
    for w, n in words.items():
        out[core(w)] += n
    return out


def grouped_texts(texts: DataFrame) -> DataFrame:
    """(tid, text, y, g): texts with their group of copies. Texts with equal
    hashes are one node, so that copies make no links among themselves."""
    nodes = cut_lineage(texts.groupBy(*_PRINTS).agg(F.min("tid").alias("node")), "prints")
    keys = nodes.select("node", F.posexplode(F.array(*_PRINTS)).alias("k", "low"))
    roots = keys.groupBy("k", "low").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = keys.join(roots, ["k", "low"]).where("node <> v").select(F.col("node").alias("u"), "v").distinct()
    star = simhash.components(edges)
    groups = (nodes.join(star, nodes["node"] == star["u"], "left")
              .select(*_PRINTS, F.coalesce("v", "node").alias("g")))
    small = nodes.count() <= BROADCAST_GROUPS
    return texts.join(F.broadcast(groups) if small else groups, _PRINTS).select("tid", "text", "y", "g")


def held_features(texts: DataFrame, letters: Letters) -> DataFrame:
    """(tid, g, f): every feature of every text."""
    def run(rows):
        read = Readings(letters)
        for tid, text, g in rows:
            for f in read.text(text.split()):
                yield tid, g, f

    return map_rows(texts.select("tid", "text", "g"), run, T.StructType.fromDDL("tid long, g long, f string"),
                    batch_rows=20_000)


def searched(texts: DataFrame, letters: Letters, candidates: DataFrame, most: Column | None = None) -> DataFrame:
    """(f, g): groups of texts that hold a candidate feature, distinct within a
    task. With ``most``, a task stops at one group more than that (a long of the
    candidates), where the number no longer matters.

    Candidates go to the tasks in portions of at most about ``CANDIDATES``.
    """
    spark = texts.sparkSession
    schema = T.StructType.fromDDL("f string, g long")
    portions = -(-candidates.count() // CANDIDATES)
    found = spark.createDataFrame([], schema)
    for i in range(portions):
        part = candidates.where(F.pmod(F.xxhash64("f"), F.lit(portions)) == i)
        part = part.select("f", (F.lit(-1) if most is None else most).cast("long").alias("most")).toArrow()
        of = dict(zip(part["f"].to_pylist(), part["most"].to_pylist(), strict=True))

        def run(rows, of=of):
            read = Readings(letters, of)
            seen: dict[str, set[int]] = defaultdict(set)  # groups, up to the number that matters
            done: set[str] = set()  # words without a feature that still matters
            for text, g in rows:
                words = text.split()
                held: set[str] = set()
                if len(done) >= KNOWN_WINDOWS:
                    done.clear()
                for w in {*words, *spaced(words)} - done:
                    own = [f for f in read.word(w) if of[f] < 0 or len(seen[f]) <= of[f]]
                    if own:
                        held.update(own)
                    else:
                        done.add(w)
                for f in held:
                    if of[f] < 0:
                        yield f, g
                    elif g not in seen[f]:
                        seen[f].add(g)
                        yield f, g

        found = found.unionByName(map_rows(texts.select("text", "g"), run, schema, batch_rows=20_000))
    return cut_lineage(found.distinct(), "searched")


def clean_counts(clean: DataFrame, letters: Letters, toxic: DataFrame, evidence: Evidence) -> DataFrame:
    """(f, t, c) of the features (f, t) that may be marks: no clean group holds
    them, or few enough. One text in ``FIRST`` is searched first, and the others
    for what is left: groups only add up, so nothing else can be a mark."""
    t, c = F.col("t"), F.coalesce("c", F.lit(0))
    open_ = (c == 0) | evidence.telling(t, c)

    def counted(pairs: DataFrame) -> DataFrame:
        n = pairs.groupBy("f").agg(F.count_distinct("g").alias("c"))
        return toxic.join(n, "f", "left").select("f", "t", c.alias("c")).where(open_)

    early = F.pmod(F.xxhash64("tid"), F.lit(FIRST)) == 0
    first = searched(clean.where(early), letters, toxic)
    rest = cut_lineage(counted(first), "open")
    # from t / 4 clean groups on a feature is no mark
    others = searched(clean.where(~early), letters, rest, F.ceil(t / 4))
    return cut_lineage(counted(first.join(rest.select("f"), "f", "left_semi").unionByName(others))
                       .join(rest.select("f"), "f", "left_semi"), "clean_counts")


def cover(pairs: DataFrame) -> list[str]:
    """``covering`` over (tid, f) pairs: with sorted counts while there are
    many, the rest in memory."""
    chosen: list[str] = []
    while True:
        shared = pairs.groupBy("f").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        pairs = cut_lineage(pairs.join(shared.select("f"), "f", "left_semi"), "uncovered")
        if pairs.count() <= COVER_PAIRS:
            break
        best = shared.orderBy(F.desc("n"), F.length("f"), F.desc("f")).first()["f"]
        chosen.append(best)
        pairs = pairs.join(pairs.where(F.col("f") == best).select("tid"), "tid", "left_anti")
    left: dict[int, set[str]] = defaultdict(set)
    for r in pairs.collect():
        left[r["tid"]].add(r["f"])
    return chosen + list(covering(list(left.values())))


def trained(docs: DataFrame, labels: DataFrame, *, train: Column, id_col: str = "doc_id",
            text_col: str = "text") -> Model:
    """``fit`` over all labelled training texts, as Spark aggregates; the driver
    holds the letter pairs, the marks and at most ``CANDIDATES`` features."""
    texts = training_texts(docs, labels, train=train, id_col=id_col, text_col=text_col)
    letters = counted_letters(texts)
    grouped = grouped_texts(texts)
    sides = (grouped.groupBy("g").agg(F.max("y").alias("toxic"), F.min("y").alias("y"))
             .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("y")).alias("clean")).first())
    if not sides["toxic"]:
        drop_stage(texts)
        return Model({}, letters)
    bad, clean = grouped.where("y = 1"), grouped.where("y = 0")
    pairs = cut_lineage(held_features(bad, letters), "toxic_features")
    toxic = cut_lineage(pairs.groupBy("f").agg(F.count_distinct("g").alias("t")), "toxic_counts")
    evidence = Evidence(sides["toxic"], sides["clean"], toxic.count())
    counts = clean_counts(clean, letters, toxic.where("t > 1"), evidence)
    strong = {r["f"]: (r["t"], r["c"]) for r in counts.where(evidence.telling(F.col("t"), F.col("c"))).collect()}
    marked = pairs.join(_listed(pairs, strong), "f", "left_semi").select("tid").distinct()
    free = pairs.join(counts.where("c = 0").select("f"), "f", "left_semi")
    more = cover(free.join(marked, "tid", "left_anti").select("tid", "f"))
    strong |= {r["f"]: (r["t"], 0) for r in toxic.join(_listed(toxic, more), "f", "left_semi").collect()}
    longer = longer_marks(strong)
    if longer:
        over = toxic.sparkSession.createDataFrame([(f, g) for f, gs in longer.items() for g in gs], "of string, f string")
        covered = (pairs.join(F.broadcast(over), "f").groupBy("of").agg(F.count_distinct("g").alias("n")).collect())
        for r in covered:
            if r["n"] >= 0.9 * strong[r["of"]][0]:
                del strong[r["of"]]
    kept = needed(strong)
    names = _names(bad, clean, kept) if kept else frozenset()
    for stage in (pairs, texts):
        drop_stage(stage)
    return Model({f: evidence.chance(*strong[f]) for f in kept}, letters, names=names)


def _listed(df: DataFrame, features: Iterable[str]) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame([(f,) for f in features], "f string"))


def _names(bad: DataFrame, clean: DataFrame, kept: set[str]) -> frozenset[str]:
    """Whole words with a mark that toxic texts have and no clean one."""
    def found(texts: DataFrame, wanted) -> set[str]:
        def run(rows):
            seen: set[str] = set()
            for (text,) in rows:
                new = wanted(set(text.split())) - seen
                seen |= new
                yield from ((c,) for c in new)

        return {r["c"] for r in map_rows(texts.select("text"), run, T.StructType.fromDDL("c string")).distinct().collect()}

    names = found(bad, lambda words: marked_cores(words, kept))
    if names:
        starts = {c[:2] for c in names}
        # a word that begins with two letters begins its core
        names -= found(clean, lambda words: {core(w) for w in words
                                             if w.lower()[:2] in starts or not w[:2].isalpha()} & names)
    return frozenset(names)


def score_documents(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    return docs.withColumn(score_col, scorer(model)(F.col(text_col)))
