"""Abusive, hateful or sexual content: class-conditional Kneser-Ney models over normalised characters.

Two character models, one of offending and one of ordinary sentences, score every sentence by the
difference of their log-likelihoods, plus the log of their prior odds, normalised by length; a document's score is that of its worst
sentence, or of a stretch inside one that is far worse than the rest of it.  Class-specific counts of orders 5 to 2 back off, with absolute discounts and continuation
counts, to one unigram distribution shared by both classes, so what neither class has seen says nothing
and rare expressions are judged by their parts.

Labels are given per document, and an offending document is mostly ordinary text.  Hence the fit finds
the offending sentences: the toxic model starts from sentences of offending documents, and in each round
keeps the best one of each; at last each part of the documents is judged by a model of the others, which drops documents
labelled wrongly.  The fit runs on at most ``FIT_DOCS`` labelled documents per class; scoring is one pass
over all documents in Arrow batches, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomgraph.workspace import Workspace

#: Labelled documents of each class used for the fit, at most; which ones is decided by a hash of the id.
FIT_DOCS = 4000
ORDER = 5
ROUNDS = 2
#: Parts of the offending documents for the last choice of sentences, each judged by the others.
FOLDS = 4
#: Added to a sentence's length, so that a few characters alone can't decide.
STEADY = 6.0
THRESHOLD = 0.1
#: Stretches of so many characters count by themselves if they score so much above the threshold: remarks that run into other text without an end.
WINDOWS, WINDOW_LEAD = (12, 24, 48), 0.7
#: Share of offending documents labelled ordinary, and the lead in log-likelihood that calls a sentence innocent: with a label for it, and without.
NOISE, MARGIN, UNLABELLED = 0.08, 3.0, 5.0
SLICE_CHARS = 1_000_000
_END, _SPACE, _LETTER, _DIGIT, _OTHER, _DROP = 1, 2, 3, 4, 5, 6
#: Letters of other alphabets and signs used in place of Latin letters (fixed values).
_ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "ı": "i", "ß": "s", "ø": "o", "ł": "l"}
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}
_tables: list[np.ndarray] = []


def _char_tables() -> list[np.ndarray]:
    """For each code point: its normal form, its class, and the letter it may stand for."""
    if _tables:
        return _tables
    n = 0x110000
    normal, kind, leet = np.arange(n, dtype=np.uint32), np.full(n, _OTHER, np.uint8), np.zeros(n, np.uint32)
    ends = set("。！？!?；;\n\r…\u2028\u2029")
    for c in range(n):
        if 0x3400 <= c <= 0x9FFF or 0xAC00 <= c <= 0xD7A3 or 0x20000 <= c <= 0x3FFFF:
            kind[c] = _LETTER
            continue
        if 0xD800 <= c <= 0xF8FF or c >= 0xE0000 or 0x40000 <= c:
            kind[c] = _DROP if c >= 0xE0000 else _OTHER
            continue
        ch = chr(c)
        cat = unicodedata.category(ch)
        if cat in ("Cf", "Mn", "Me", "Cn", "Cs"):
            kind[c] = _DROP
            continue
        if ch in ends:
            kind[c] = _END
            continue
        low = unicodedata.normalize("NFKD", ch).lower()
        base = next((x for x in low if unicodedata.category(x) != "Mn"), ch)
        base = _ALIKE.get(base, base)
        normal[c] = ord(base)
        cat = unicodedata.category(base)
        kind[c] = _LETTER if cat[0] == "L" else _DIGIT if cat[0] == "N" else _SPACE if cat[0] == "Z" or cat == "Cc" else _OTHER
        if kind[c] == _DIGIT and ch not in _LEET:
            normal[c] = ord("0")
    for a, b in _LEET.items():
        leet[ord(a)] = ord(b)
    _tables.extend([normal, kind, leet])
    return _tables


@dataclass
class Sentences:
    """Normalised characters of many texts in a row; each sentence starts with a 0."""

    chars: np.ndarray
    start: np.ndarray
    text: np.ndarray

    def lengths(self) -> np.ndarray:
        return np.diff(np.concatenate([self.start, [len(self.chars)]]))

    def keys(self) -> np.ndarray:
        """A hash of each sentence."""
        place = np.arange(len(self.chars)) - np.repeat(self.start, self.lengths())
        c = (self.chars.astype(np.uint64) + np.uint64(7)) * np.uint64(0xD6E8FEB86659FD93)
        c = (c ^ (c >> np.uint64(31))) * (np.uint64(2) * place.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        return np.add.reduceat(c, self.start) if len(self.start) else np.empty(0, np.uint64)

    def pick(self, which: np.ndarray) -> "Sentences":
        size = self.lengths()
        keep = np.repeat(which, size)
        left = size[which]
        return Sentences(self.chars[keep], np.cumsum(left) - left, self.text[which])

    def show(self, i: int) -> str:
        return "".join(map(chr, self.chars[self.start[i] + 1 : self.start[i] + self.lengths()[i]]))


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)
    return edge, np.diff(np.concatenate([edge, [len(x)]]))


def sentences(texts: list[str | None]) -> Sentences:
    """Cut texts into sentences of normalised characters.

    Case, width, accents, look-alike letters, invisible characters, signs put between single letters,
    digits used as letters and stretched letters are undone; numbers become one 0, white space one space.
    """
    normal, kind, leet = _char_tables()
    raw = np.frombuffer("\n".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.fromiter((len(t or "") + 1 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), size)[: len(raw)]
    k = kind[raw]
    # a full stop and a colon end a sentence only before white space, an ideograph or an end
    dot = np.flatnonzero((raw == ord(".")) | (raw == ord(":")))
    nxt = k[np.minimum(dot + 1, len(raw) - 1)] if len(raw) else k[:0]
    wide_next = raw[np.minimum(dot + 1, len(raw) - 1)] >= 0x2E80 if len(raw) else nxt > 0
    k[dot[(nxt == _SPACE) | (nxt == _END) | wide_next | (dot + 1 == len(raw))]] = _END
    # an exclamation mark inside a word is no end
    bang = np.flatnonzero((raw == ord("!")) | (raw == ord("?")))
    inner = bang[(bang > 0) & (bang + 1 < len(raw))]
    inner = inner[(k[inner - 1] == _LETTER) & (k[inner + 1] == _LETTER) & (raw[inner - 1] < 0x250) & (raw[inner + 1] < 0x250)]
    k[inner] = _OTHER
    keep = k != _DROP
    c, k, owner, r = normal[raw][keep], k[keep], owner[keep], raw[keep]
    if not len(c):
        return Sentences(np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int32))
    # digits and signs between Latin letters stand for letters
    sub = leet[r]
    latin = (k == _LETTER) & (c < 0x250)
    near = np.zeros(len(c), bool)
    near[1:-1] = latin[:-2] & latin[2:]
    swap = near & (sub > 0)
    c[swap], k[swap] = sub[swap], _LETTER
    # single letters set apart by single signs: the signs go
    letter = k == _LETTER
    gap = ((k == _SPACE) | (k == _OTHER)) & ~letter
    between = np.zeros(len(c), bool)
    between[1:-1] = gap[1:-1] & letter[:-2] & letter[2:]
    lone = letter.copy()
    lone[1:] &= ~letter[:-1]
    lone[:-1] &= ~letter[1:]
    tie = np.zeros(len(c), bool)
    tie[1:-1] = between[1:-1] & lone[:-2] & lone[2:]
    # a single sign or space between ideographs goes, and a star or dot inside a word
    wide = letter & (c >= 0x2E80)
    parted = np.zeros(len(c), bool)
    parted[1:-1] = gap[1:-1] & wide[:-2] & wide[2:] & np.isin(c[1:-1], np.frombuffer(" *·•^~`'_-./|+".encode("utf-32-le"), np.uint32))
    star = np.zeros(len(c), bool)
    star[1:-1] = between[1:-1] & np.isin(c[1:-1], np.frombuffer("*·•^~`'".encode("utf-32-le"), np.uint32))
    keep = ~(tie | star | parted)
    c, k, owner = c[keep], k[keep], owner[keep]
    k[(k == _OTHER) & (c < 32)] = _SPACE
    c[k == _SPACE] = 32
    c[k == _DIGIT] = ord("0")
    c[k == _END] = 0
    # stretched letters, numbers and white space become one
    edge, length = _runs(c)
    mult = (length == 2) & (k[edge] == _LETTER)
    keep = np.zeros(len(c), bool)
    keep[edge] = True
    keep[edge[mult] + 1] = True
    c, k, owner = c[keep], k[keep], owner[keep]
    number = (c == ord("0"))
    point = np.zeros(len(c), bool)
    point[1:-1] = ((c[1:-1] == ord(".")) | (c[1:-1] == ord(","))) & number[:-2] & number[2:]
    drop = point.copy()
    drop[2:] |= point[1:-1] & number[2:]
    c, owner = c[~drop], owner[~drop]
    # every sentence starts with one 0, also the first of a text
    end = c == 0
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    blank = c == 32
    after = np.concatenate([[True], end[:-1]])
    drop = (end & np.concatenate([[False], end[:-1]])) | (blank & (after | first))
    c, owner, end = c[~drop], owner[~drop], end[~drop]
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) & ~end if len(c) else end
    at = np.flatnonzero(first)
    c, owner = np.insert(c, at, 0), np.insert(owner, at, owner[at])
    start = np.flatnonzero(c == 0)
    s = Sentences(c, start, owner[start])
    return s.pick(s.lengths() > 1)


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _ngram_hashes(chars: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1- to ``order``-grams that end at each character; grams reach back over a sentence's start as far as its 0."""
    c = (chars.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    c ^= c >> np.uint64(32)
    out = [c * _MIX]
    zero = chars == 0
    stop = zero.copy()
    power = c
    total = c.copy()
    for k in range(1, order):
        # the k-th character back, none beyond the start of the sentence
        back = np.zeros_like(c)
        back[k:] = c[:-k]
        back[stop] = 0
        power = back * np.uint64((0xA24BAED4963EE407 * (2 * k + 1)) & 0xFFFFFFFFFFFFFFFF)
        total = total + (power ^ (power >> np.uint64(29)))
        out.append(total * _MIX + np.uint64(k))
        nxt = np.zeros_like(stop)
        nxt[k:] = zero[:-k]
        stop |= nxt
    return out


class Table:
    """Hash to value, by open addressing: a key lies in its own slot or the next free one, so none is lost; a miss gives 0 and False."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        n = max(1, len(keys))
        bits = max(10, min(22, int(np.ceil(np.log2(n))) + 3), int(np.ceil(np.log2(n))) + 1)  # at most half full
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.print, self.value = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.float32)
        slot, mark = self._places(keys)
        rest = np.arange(len(keys))
        while len(rest):
            free = rest[self.print[slot[rest]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.print[slot[placed]], self.value[slot[placed]] = mark[placed], values[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            rest = rest[left[rest]]
            slot[rest] = (slot[rest] + 1) & self.last

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First slot and mark of each key; 0 marks a free slot."""
        return (keys >> self.shift).astype(np.int64), np.maximum(keys.astype(np.uint32), np.uint32(1))

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot, mark = self._places(keys)
        there = self.print[slot]
        hit = there == mark
        value = np.where(hit, self.value[slot], np.float32(0))
        rest = np.flatnonzero(~hit & (there != 0))
        at = slot[rest]
        while len(rest):
            at = (at + 1) & self.last
            there = self.print[at]
            found = there == mark[rest]
            hit[rest[found]], value[rest[found]] = True, self.value[at[found]]
            go = ~found & (there != 0)
            rest, at = rest[go], at[go]
        return value, hit


class Counts:
    """Counts of one class for every order: keys, counts, keys of the lower gram and of the context."""

    def __init__(self, s: Sentences, order: int):
        h = _ngram_hashes(s.chars, order)
        real = s.chars != 0
        self.n_sentences = len(s.start)
        self.pairs, at = np.unique(h[1][real], return_index=True)
        self.last = h[0][real][at]
        self.per = {}
        for k in range(2, order + 1):
            full, low, ctx = h[k - 1][real], h[k - 2][real], np.concatenate([np.zeros(1, np.uint64), h[k - 2][:-1]])[real]
            if k < order:  # continuation counts: distinct characters before the gram
                _, at = np.unique(h[k][real], return_index=True)
                full, low, ctx = full[at], low[at], ctx[at]
            key, at, n = np.unique(full, return_index=True, return_counts=True)
            self.per[k] = key, n, low[at], ctx[at]


class KneserNeyPair:
    """Toxic and ordinary model in one table: log-likelihood ratios of seen grams and of backing off."""

    def __init__(self, toxic: Counts, ordinary: Counts, order: int = ORDER):
        self.order = order
        self.prior = float(np.log((toxic.n_sentences + 1) / (ordinary.n_sentences + 1)))
        # shared unigrams: continuation counts over both classes together
        pairs, first = np.unique(np.concatenate([toxic.pairs, ordinary.pairs]), return_index=True)
        lower_keys, n = np.unique(np.concatenate([toxic.last, ordinary.last])[first], return_counts=True)
        shared = np.log((n + 0.5) / (n.sum() + 0.5 * len(n) + 1))
        lower = [shared, shared]
        seen, back = ([], []), ([], [])
        for k in range(2, order + 1):
            per = [c.per[k] for c in (toxic, ordinary)]
            keys = np.unique(np.concatenate([per[0][0], per[1][0]]))
            low_of, ctx_of = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint64)
            count = np.zeros((2, len(keys)))
            for i in (0, 1):
                at = np.searchsorted(keys, per[i][0])
                count[i, at], low_of[at], ctx_of[at] = per[i][1:]
            ctx, ctx_at = np.unique(ctx_of, return_inverse=True)
            low_at = np.searchsorted(lower_keys, low_of)
            logp, log_gamma = [], []
            for i in (0, 1):
                ones, twos = (count[i] == 1).sum(), (count[i] == 2).sum()
                d = min(0.95, max(0.4, ones / max(1, ones + 2 * twos)))
                total = np.bincount(ctx_at, count[i], len(ctx))
                kinds = np.bincount(ctx_at, count[i] > 0, len(ctx))
                gamma = np.where(total > 0, d * kinds / np.maximum(total, 1), 1.0)
                own = np.where(total[ctx_at] > 0, np.maximum(count[i] - d, 0) / np.maximum(total[ctx_at], 1), 0)
                logp.append(np.log(own + gamma[ctx_at] * np.exp(lower[i][low_at])))
                log_gamma.append(np.log(gamma))
            for to, x in zip(seen, (keys, logp[0] - logp[1])):
                to.append(x)
            for to, x in zip(back, (ctx * _MIX + np.uint64(k), log_gamma[0] - log_gamma[1])):
                to.append(x)
            lower_keys, lower = keys, logp
        self.seen = Table(*map(np.concatenate, seen))
        self.back = Table(*map(np.concatenate, back))

    def ratios(self, s: Sentences) -> np.ndarray:
        """Log-likelihood ratio of each character given those before it."""
        h = _ngram_hashes(s.chars, self.order)
        value = np.zeros(len(s.chars), np.float32)
        for k in range(2, self.order + 1):
            ctx = np.concatenate([np.zeros(1, np.uint64), h[k - 2][:-1]]) * _MIX + np.uint64(k)
            back, known = self.back.get(ctx)
            own, seen = self.seen.get(h[k - 1])
            value = np.where(seen, own, np.where(known, value + back, value))
        value[s.chars == 0] = 0
        return value

    def score(self, s: Sentences, windows: tuple[int, ...] = ()) -> np.ndarray:
        """Length-normalised log-likelihood ratio of each sentence, or of its worst stretch of so many characters less ``WINDOW_LEAD`` if that is higher."""
        if not len(s.start):
            return np.empty(0)
        sums = np.concatenate([[0.0], np.cumsum(self.ratios(s), dtype=np.float64)])
        size = s.lengths() - 1
        best = (sums[s.start + size + 1] - sums[s.start] + self.prior) / (size + STEADY)
        place = np.arange(len(s.chars)) - np.repeat(s.start, size + 1)
        for w in windows:
            end = np.flatnonzero(place >= w)
            if len(end):
                of = np.searchsorted(s.start, end, "right") - 1
                edge, _ = _runs(of)
                x = np.maximum.reduceat(sums[end + 1] - sums[end + 1 - w], edge)
                best[of[edge]] = np.maximum(best[of[edge]], (x + self.prior) / (w + STEADY) - WINDOW_LEAD)
        return best


def fit(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS, folds: int = FOLDS) -> KneserNeyPair:
    """Models from labelled documents; see the module's text for how offending sentences are found."""
    s = sentences(texts)
    bad = labels[s.text] == 1
    suspect, at = s.pick(bad), s.text[bad]
    ordinary = Counts(s.pick(~bad), ORDER)

    def best_of(x: np.ndarray) -> np.ndarray:
        """The best sentence of an offending document is offending, if any is."""
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, at, x)
        return (x >= best[at]) & (x > 0)

    taught = np.ones(len(at), bool)
    for _ in range(rounds):
        taught = best_of(KneserNeyPair(Counts(suspect.pick(taught), ORDER), ordinary).score(suspect))
    # documents labelled wrongly have no offending sentence; a model that was not taught by them sees it
    fold = at % folds
    x = np.zeros(len(at))
    for i in range(folds if taught.any() else 0):
        mine = fold == i
        x[mine] = KneserNeyPair(Counts(suspect.pick(taught & ~mine), ORDER), ordinary).score(suspect.pick(mine))
    taught = best_of(x) if (x > 0).any() else taught
    return KneserNeyPair(Counts(suspect.pick(taught), ORDER), ordinary)


def _votes(labels: DataFrame) -> DataFrame:
    return labels.where("abusive is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("abusive") >= 0.5).cast("int").alias("abusive"))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCS) -> tuple[list[str], np.ndarray]:
    """Texts and labels of at most ``per_class`` documents of each class, chosen by a hash of the id.

    Of several reviews of a document the majority counts, a tie as offending; null reviews don't count.
    """
    votes = _votes(labels)
    pick = lambda c: votes.where(F.col("abusive") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    # at most 2 * per_class rows, hence safe to broadcast
    chosen = F.broadcast(pick(1).unionByName(pick(0)))
    rows = docs.select("doc_id", "text").where("text is not null").join(chosen, "doc_id").orderBy("doc_id", "text").select("text", "abusive").toArrow()
    return rows.column("text").to_pylist(), np.asarray(rows.column("abusive"))


def _sliced(texts: list[str | None]) -> Iterator[list[str | None]]:
    part, chars = [], 0
    for t in texts:
        part.append(t)
        chars += len(t or "")
        if chars >= SLICE_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def _read(docs: DataFrame, model: KneserNeyPair, threshold: float) -> DataFrame:
    """``doc_id, source, base`` (the best score up to the threshold), ``over``: key and score of each sentence beyond it, and ``text_key``: a hash of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    item = pa.list_(pa.struct([("key", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, over = [], []
            for part in _sliced(batch.column(2).to_pylist()):
                s = sentences(part)
                x = shared.value.score(s, WINDOWS)
                low = np.full(len(part), -np.inf)
                calm = x <= threshold
                np.maximum.at(low, s.text[calm], x[calm])
                base.append(np.where(np.isfinite(low), low, np.nan))
                mine: list[dict[int, float]] = [{} for _ in part]
                for i, k, v in zip(s.text[~calm].tolist(), s.keys().view(np.int64)[~calm].tolist(), x[~calm].tolist()):
                    mine[i][k] = v
                over += [[{"key": k, "score": v} for k, v in m.items()] for m in mine]
            low = np.concatenate(base) if base else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(low, pa.float64(), from_pandas=True), pa.array(over, item), batch.column(3)], ["doc_id", "source", "base", "over", "text_key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "source", "text", F.xxhash64("text")).mapInArrow(run, f"doc_id {kind}, source string, base double, over array<struct<key: bigint, score: double>>, text_key bigint")


def innocent_sentences(read: DataFrame, labels: DataFrame) -> DataFrame:
    """``key`` of sentences that the model finds offending and labels show to be ordinary.

    A sentence may be new to the labelled sample and only look offending.  ``n`` distinct texts hold it; were it
    offending, about n * (labelled offending / all flagged texts) of them would be labelled offending and few
    (``NOISE``) labelled ordinary; if it is ordinary, labels fall on it as on any document.  The Poisson
    likelihoods of both counts decide.  Rows of equal texts count once.  Where no text is labelled ordinary, the lead has to be
    ``UNLABELLED``: an offending sentence of so many texts would go without a label once in 150 times.  Where a text is
    labelled offending, the labels have to reach the lead by themselves, whatever the number of texts.  A text whose documents
    are labelled differently counts as offending.
    """
    votes = _votes(labels)
    label = {r["abusive"]: r["count"] for r in votes.groupBy("abusive").count().collect()}
    n_bad, n_good = max(1, label.get(1, 0)), max(1, label.get(0, 0))
    n = max(1, read.count())
    ordinary = n_good / (n_good + n_bad)
    flagged = read.where(F.size("over") > 0)
    c = lambda x: F.coalesce(F.sum((F.col("abusive") == x).cast("int")), F.lit(0))
    texts = flagged.select("doc_id", "text_key").distinct().join(votes, "doc_id", "left").groupBy("text_key").agg(F.max("abusive").alias("abusive"))
    sizes = texts.agg(F.count(F.lit(1)).alias("n"), c(1).alias("bad")).first()
    held = flagged.select("text_key", F.explode("over.key").alias("key")).distinct().join(texts, "text_key")
    counts = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), c(1).alias("bad"), c(0).alias("good"))
    poisson = lambda k, mean: F.col(k) * F.log(mean) - mean
    if_bad, if_not = F.col("n") * (max(1, sizes["bad"]) / max(1, sizes["n"])), F.col("n") * (n_bad / n)
    good_bad, good_not = if_bad * NOISE, F.col("n") * (n_good / n)
    lead = poisson("bad", if_not) + poisson("good", good_not) - poisson("bad", if_bad) - poisson("good", good_bad)
    by_labels = F.col("good") * float(np.log(ordinary / NOISE)) + F.col("bad") * float(np.log((1 - ordinary) / (1 - NOISE)))
    enough = F.when(F.col("good") > 0, MARGIN).otherwise(UNLABELLED)
    return counts.where((lead > enough) & ((F.col("bad") == 0) | (by_labels > MARGIN))).select("key")


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = FIT_DOCS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, source, score, offending`` of every document.

    The score is that of the worst sentence which is not an innocent one (:func:`innocent_sentences`).  It is null for a null, empty or blank text, one
    of innocent sentences only, and for all documents if one of the classes has no labelled document; such documents are not offending.  Equal
    texts have equal scores, repeated rows stay, null ids and sources are kept, an empty table gives no
    rows; only doc_id, text and source are read.
    """
    texts, y = labelled_sample(docs, labels, per_class)
    if len(set(y.tolist())) < 2:
        return docs.select("doc_id", "source", F.lit(None).cast("double").alias("score"), F.lit(False).alias("offending"))
    ws = Workspace(docs.sparkSession, "toxicity")
    read = ws.write(_read(docs, fit(texts, y), threshold), "read")
    innocent = ws.write(innocent_sentences(read, labels), "innocent")
    calm = read.where(F.size("over") == 0).select("doc_id", "source", F.col("base").alias("score"))
    # flagged documents are few; each keeps its line, so repeated rows stay apart
    flagged = read.where(F.size("over") > 0).withColumn("line", F.monotonically_increasing_id())
    flagged = ws.write(flagged, "flagged")
    left = flagged.select("line", F.explode("over").alias("x")).select("line", "x.key", "x.score").join(innocent, "key", "left_anti")
    worst = left.groupBy("line").agg(F.max("score").alias("worst"))
    judged = flagged.join(worst, "line", "left").select("doc_id", "source", F.coalesce("worst", "base").alias("score"))
    return calm.unionByName(judged).withColumn("offending", F.coalesce(F.col("score") > threshold, F.lit(False)))


def rates_per_source(scores: DataFrame) -> DataFrame:
    """``source, n_documents, n_offending, rate``; documents without a source are a group of their own."""
    bad = F.sum(F.col("offending").cast("bigint"))
    return scores.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), bad.alias("n_offending"), (bad / F.count(F.lit(1))).alias("rate"))
