"""Toxicity of texts whose words may be disguised: restore first, then score.

Restoring. Stretches that may be disguised (letters and signs for letters as in "1d10t" or "a$$", three or more single
letters or signs with gaps as in "i d i o t" or "f/o/o/l", words with a letter twice in a row as in "idiooot" or
"iddiioott") become character lattices: a sign may stand for any of its letters, or for itself after the last letter, a gap
may be nothing, a repeated letter may be one, however it is written. The Viterbi path under a trigram model of characters,
plus what each step through the noisy channel costs, is the restored word, so that "fool", "f00l" and "f o o l" become one
word. Signs without any letter between them or gaps are taken for numbers. The model's counts cover the letters of all documents given.

Scoring. Features of a word are itself and its first 4, 5 and 6 letters. Over labelled rows, those are kept whose
presence in toxic and clean documents differs beyond chance (log-likelihood ratio, below) and that clean documents
hardly have, as one word may decide. Each feature
weighs its shrunken log odds, so one that a few clean texts have, too, still counts. A document's score is a logistic function of the weights of
its different words, fitted on the same rows. Labelled rows are a sample by hash of about ``LABELLED`` rows of a class at most; near copies
in this sample, in which all words of one toxic text would look toxic, are left out: rows alike a kept row of their class
and smaller id in ``ALIKE`` of their five-word shingles or more, as ``HASHES`` MinHash values tell. A model's ``rows`` says how many
clean and toxic rows were sampled and how many of them stayed.

The bounds above are counted in distinct pairs of doc_id and label, with one document each: labels with a null doc_id teach nothing,
repeated ones count once, and of documents with one doc_id the one with the least hash of its text counts. All features that tell enough
are kept, as few as the sample has, and all of a text's words count.

Null and empty texts score as texts without toxic words. Without any toxic or any clean label, scores are the share of toxic
labels (0 if there are none). Repeated rows are scored alike; an empty table gives an empty table. Columns other than
doc_id and text (labels: doc_id and toxic) are ignored.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import lean, written

#: Clean and toxic labelled rows that features are learned from.
LABELLED = (24_000, 8_000)
#: Features: least documents, least log-likelihood ratio, and least log odds, as very many texts make small differences sure.
LEAST_DOCS, LEAST_RATIO, LEAST_ODDS = 3, 16.0, 3.0
#: Documents of each class that a feature is thought to stand in before any is seen, which draws the weights of rare ones to nothing.
SHRINK = 0.5
#: Steps of a text's weight in which the labelled texts are counted.
STEPS = 4
#: MinHash values by which the sample is rid of near copies, values that are looked up together, and the share of equal ones that makes a copy.
HASHES, BAND, ALIKE = 128, 4, 0.8
THRESHOLD = 0.3
#: Texts whose characters are counted together; their codes take some 80 bytes a character.
AT_ONCE = 200
#: Longer stretches are restored anew each time, and no more than so many are remembered by a task, some 10 MB.
LONG, REMEMBERED = 64, 40_000

#: The signs that stand for letters.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "¢": "c"}
#: What a step through the channel costs, as a negative log probability.
SIGN_COST, DROP_REPEAT, DROP_GAP, KEEP_GAP = 1.0, 0.5, 0.1, 3.0
#: A sign that isn't a letter costs as much as a gap that is kept; in gaps wider than most of a stretch, blank and nothing change places.
KEEP_SIGN = KEEP_GAP
#: White space, marks of zero width, and punctuation that isn't a sign.
GAPS = "".join(c for c in string.punctuation if c not in SIGNS) + string.whitespace + "\xa0\xad\u2002\u2003\u2009\u200b\u200c\u200d\u202f\u2060\u3000\ufeff·•…‐‑‒–—‘’“”«»"

_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿœ"
_OTHER, SIZE = len(_LETTERS) + 1, 64
_CODE = {c: i + 1 for i, c in enumerate(_LETTERS)}
WORDS = re.compile(r"[^\W\d_]+")
_LETTER, _SIGN, _GAP = r"[^\W\d_]", f"[{re.escape(''.join(SIGNS))}]", f"[{re.escape(GAPS)}]"
_EITHER = rf"(?:{_LETTER}|{_SIGN})"
DISGUISED = re.compile(
    r"(?<![^\W_])(?:"
    rf"{_EITHER}(?:{_GAP}++{_EITHER}(?![^\W_])){{2,}}+"
    rf"|(?:{_LETTER}++{_SIGN}|{_SIGN}++{_LETTER}){_EITHER}*+"
    rf"|{_LETTER}*?({_LETTER})\1{_LETTER}*+)"
)
_PARTS = re.compile(rf"{_GAP}+|.")


def _coded(text: str) -> np.ndarray:
    """Codes of the characters of lower-case text: 0 for what is no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _TABLE[np.minimum(points, len(_TABLE) - 1)]


def _table() -> np.ndarray:
    table = np.array([_CODE.get(chr(i), _OTHER if chr(i).isalpha() else 0) for i in range(0x3000)], dtype=np.int64)
    return np.append(table, _OTHER)


_TABLE = _table()


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each three characters follow each other in all texts; at most SIZE ** 3 sums reach the driver."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SIZE**3, dtype=np.int64)
        for frame in frames:
            for start in range(0, len(frame), AT_ONCE):
                codes = _coded("  ".join(t for t in frame["text"].iloc[start : start + AT_ONCE] if t).lower())
                if len(codes) > 2:
                    total += np.bincount(codes[:-2] * SIZE**2 + codes[1:-1] * SIZE + codes[2:], minlength=SIZE**3)
        if len(found := np.flatnonzero(total)):
            yield pd.DataFrame({"three": found, "n": total[found]})

    sums = docs.select("text").mapInPandas(lean(count), "three long, n long").groupBy("three").agg(F.sum("n").alias("n"))
    counts = np.zeros(SIZE**3)
    for row in sums.collect():
        counts[row["three"]] = row["n"]
    return counts.reshape(SIZE, SIZE, SIZE)


def costs(counts: np.ndarray) -> np.ndarray:
    """-log p(third | first, second), the model mixed with those of fewer characters."""
    one = (counts.sum((0, 1)) + 0.5) / (counts.sum() + 0.5 * SIZE)
    two = (counts.sum(0) + 5 * one) / (counts.sum((0, 2))[:, None] + 5)
    three = (counts + 5 * two[None]) / (counts.sum(2, keepdims=True) + 5)
    return -np.log(three).astype(np.float32)


class Restorer:
    def __init__(self, cost: np.ndarray):
        self.cost = cost.tolist()
        self.known: dict[str, str] = {}

    def viterbi(self, stretch: str) -> str:
        """The likeliest word behind a lower-case stretch."""
        cost = self.cost
        # a path is its last letter and the path before, so that a step costs the same at any length
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        parts = _PARTS.findall(stretch)
        last = next((i for i in range(len(parts) - 1, -1, -1) if parts[i] not in SIGNS and parts[i][0] not in GAPS), len(parts))
        widths = Counter(len(part) for part in parts if part[0] in GAPS)
        usual = min(widths, key=lambda n: (-widths[n], n), default=0)
        before = ""
        for i, part in enumerate(parts):
            gap, sign = part[0] in GAPS, part in SIGNS
            paid = SIGN_COST if sign else 0.0
            drop, keep = (KEEP_GAP, DROP_GAP) if len(part) > usual else (DROP_GAP, KEEP_GAP)
            steps = [] if gap else [(letter, _CODE.get(letter, _OTHER)) for letter in SIGNS.get(part, part)]
            into: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (so_far, out) in paths.items():
                ways = [((b, c), so_far + paid + cost[a][b][c], letter) for letter, c in steps]
                if gap:
                    ways = [((a, b), so_far + drop, ""), ((b, 0), so_far + keep + cost[a][b][0], " ")]
                elif b and any(c == b for _, c in steps) and (b != _OTHER or part == before):
                    ways.append(((a, b), so_far + paid + DROP_REPEAT, ""))
                if sign and i > last:  # once a word has ended, more exclamation marks cost nothing
                    ways.append(((b, 0), so_far + KEEP_SIGN + cost[a][b][0], part) if b else ((a, b), so_far + (part != "!") * KEEP_SIGN, part))
                for state, total, letter in ways:
                    if state not in into or total < into[state][0]:
                        into[state] = (total, (out, letter) if letter else out)
            paths = into
            before = before if gap else part
        _, path = min(((total + (cost[a][b][0] if b else 0.0), out) for (a, b), (total, out) in paths.items()), key=lambda x: x[0])
        letters = []
        while path:
            path, letter = path
            letters.append(letter)
        return "".join(reversed(letters))

    def _of(self, match: re.Match) -> str:
        stretch = match[0]
        if len(stretch) > LONG:
            return self.viterbi(stretch)
        found = self.known.get(stretch)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[stretch] = self.viterbi(stretch)
        return found

    def restored(self, text: str | None) -> str:
        return DISGUISED.sub(self._of, (text or "").lower())


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """What scoring needs; of bounded size."""

    def __init__(self, cost: np.ndarray, weights: dict[str, float], bias: float, slope: float):
        self.cost, self.weights, self.bias, self.slope = cost, weights, bias, slope
        self.restorer: Restorer | None = None
        self.starts: frozenset[str] = frozenset()
        #: Per class: rows sampled, and those of them that are no near copies.
        self.rows: dict[int, tuple[int, int]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"restorer": None}

    def weight(self, text: str | None) -> float:
        """The weights of the different toxic words of text, once restored: of each the largest one of its features."""
        if self.restorer is None:
            self.restorer = Restorer(self.cost)
            #: How all features begin, so that most words cost one look.
            self.starts = frozenset(f[:4] for f in self.weights)
        get, starts = self.weights.get, self.starts
        toxic = {w for w in WORDS.findall(self.restorer.restored(text)) if w[:4] in starts}
        # the same whatever order the words are met in
        return math.fsum(max(get(w, 0.0), get(w[:4] + "*", 0.0), get(w[:5] + "*", 0.0), get(w[:6] + "*", 0.0)) for w in toxic)

    def score(self, text: str | None) -> float:
        return self._score(self.weight(text))

    def _score(self, weight: float) -> float:
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.bias + self.slope * weight))))

    def rejects(self, text: str | None) -> bool:
        """Whether text is predicted toxic for a word that it has, and not only because most labels are."""
        weight = self.weight(text)
        return weight > 0 and self._score(weight) >= THRESHOLD


def _ratio(a: Column, b: Column, all_a: float, all_b: float) -> Column:
    """Log-likelihood ratio of a feature in a of all_a toxic and b of all_b clean documents, 0 unless it speaks for toxic."""
    share = (a + b) / F.lit(all_a + all_b)

    def part(n: Column, expected: Column) -> Column:
        return F.when(n > 0, n * F.ln(n / expected)).otherwise(F.lit(0.0))

    found = part(a, share * all_a) + part(b, share * all_b) + part(F.lit(all_a) - a, (1 - share) * all_a) + part(F.lit(all_b) - b, (1 - share) * all_b)
    return F.when(a * all_b > b * all_a, 2 * found).otherwise(F.lit(0.0))


def _logistic(counts: dict[tuple[int, int], int]) -> tuple[float, float]:
    """Bias and slope by Newton steps, of (steps of weight, label) -> rows, with a weak pull towards nothing."""
    x = np.array([[1.0, k[0] / STEPS] for k in counts])
    y, n = np.array([k[1] for k in counts], dtype=float), np.array(list(counts.values()), dtype=float)
    w, pull = np.zeros(2), np.diag([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + pull, x.T @ (n * (y - p)) - pull @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


_FACTORS = np.random.default_rng(6).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _least_shingles(text: str | None) -> np.ndarray:
    """HASHES MinHash values, of 32 bits, of the five-word shingles of text; fewer words count as one."""
    words = WORDS.findall((text or "").lower())
    hashes = {w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in set(words)}
    points = np.fromiter((hashes[w] for w in words), dtype=np.uint64, count=len(words))
    many = np.zeros(max(1, len(points) - 4), dtype=np.uint64)
    for i in range(min(5, len(points))):
        many = many * np.uint64(0x9E3779B97F4A7C15) + points[i : i + len(many)]
    many ^= many >> np.uint64(29)
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(many), 1024):
        np.minimum(least, (many[start : start + 1024, None] * _FACTORS).min(axis=0), out=least)
    # the highest bits of a minimum are mostly zeros, so the ones below count as well
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def _without_copies(known: DataFrame) -> tuple[set[int], dict[int, tuple[int, int]]]:
    """Ids of sampled rows that are no near copies of a kept row of their class and smaller id; and per class, how many rows
    were sampled and kept. As bounded as the sample."""

    def least(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield pd.DataFrame({"id": frame["doc_id"], "toxic": frame["toxic"], "least": [_least_shingles(t).tobytes() for t in frame["text"]]})

    kept = set()
    values: list[np.ndarray] = []
    places: dict[tuple[int, int, bytes], list[int]] = {}
    rows = sorted(known.mapInPandas(lean(least), "id long, toxic int, least binary").collect())
    for row in rows:
        own, width = bytes(row["least"]), 4 * BAND
        bands = [(row["toxic"], i, own[i : i + width]) for i in range(0, len(own), width)]
        mine = np.frombuffer(own, dtype=np.uint32)
        near = sorted({p for band in bands for p in places.get(band, ())})
        copy = bool(near) and bool(((np.stack([values[p] for p in near]) == mine).mean(axis=1) >= ALIKE).any())
        if not copy:
            kept.add(row["id"])
            for band in bands:
                places.setdefault(band, []).append(len(values))
            values.append(mine)
    sampled, stay = Counter(row["toxic"] for row in rows), Counter(row["toxic"] for row in rows if row["id"] in kept)
    return kept, {k: (sampled[k], stay[k]) for k in (0, 1)}


def fit(docs: DataFrame, labels: DataFrame, labelled: tuple[int, int] = LABELLED) -> Model:
    """Learn from the labels of rows that aren't held out."""
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)").filter(~held_out(F.col("doc_id"))).distinct()
    sums = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bits = 1 << 40
    limit = F.create_map(*[F.lit(x).cast("long") for k in (0, 1) for x in (k, int(min(1.0, labelled[k] / max(1, sums.get(k, 0))) * bits))])
    # about sum(labelled) narrow rows at most, so they can be broadcast at any size of the tables
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(bits)) < F.element_at(limit, F.col("toxic").cast("long")))
    # of documents that share a doc_id the least by hash stands for the label; which one that is, is known before texts move
    least = F.min(F.struct(F.xxhash64("text"), "text")).alias("least")
    known = written(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(least).select("doc_id", "toxic", F.col("least.text").alias("text")))
    single, sampled = _without_copies(known)
    cost = costs(character_counts(docs))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer, seen = Restorer(cost), (Counter(), Counter())
        for frame in frames:
            for doc_id, text, toxic in zip(frame["doc_id"], frame["text"], frame["toxic"], strict=True):
                if doc_id not in single:
                    continue
                words = set(WORDS.findall(restorer.restored(text)))
                seen[toxic].update({f for w in words for f in features(w)})
        for toxic, found in enumerate(seen):
            if found:  # a frame without rows has columns without a kind
                yield pd.DataFrame({"feature": list(found), "toxic": toxic, "n": list(found.values())})

    by_class = known.mapInPandas(lean(count), "feature string, toxic int, n long").groupBy("feature").agg(
        F.coalesce(F.sum(F.when(F.col("toxic") == 1, F.col("n"))), F.lit(0)).cast("double").alias("a"),
        F.coalesce(F.sum(F.when(F.col("toxic") == 0, F.col("n"))), F.lit(0)).cast("double").alias("b"),
    )
    all_a, all_b = float(sampled[1][1]), float(sampled[0][1])
    if not all_a or not all_b:
        share = all_a / max(1.0, all_a + all_b)
        model = Model(cost, {}, math.log(max(share, 1e-9) / max(1 - share, 1e-9)), 0.0)
        model.rows = sampled
        return model
    odds = F.ln((F.col("a") + SHRINK) / (all_a + 2 * SHRINK)) - F.ln((F.col("b") + SHRINK) / (all_b + 2 * SHRINK))
    # as bounded as the sample that they stand in
    best = by_class.filter(F.col("a") >= LEAST_DOCS).filter(_ratio(F.col("a"), F.col("b"), all_a, all_b) >= LEAST_RATIO).filter(odds >= LEAST_ODDS).select("feature", odds.alias("odds")).collect()
    model = Model(cost, {r["feature"]: r["odds"] for r in best}, 0.0, 0.0)
    model.rows = sampled

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for frame in frames:
            seen.update((round(model.weight(t) * STEPS), y) for t, y in zip(frame["text"], frame["toxic"], strict=True))
        if seen:
            yield pd.DataFrame([(x, y, n) for (x, y), n in seen.items()], columns=["x", "y", "n"])

    tallied = known.mapInPandas(lean(tally), "x int, y int, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).collect()
    model.bias, model.slope = _logistic({(r["x"], r["y"]): r["n"] for r in tallied})
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "score": [model.score(t) for t in frame["text"]]})

    narrow = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = narrow.mapInPandas(lean(run), f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, with all their columns, but those that are predicted toxic. Texts without a toxic word stay in any case, as
    where labels are too few to learn from, or mostly toxic, their share alone would reject every text."""

    @F.pandas_udf("boolean")
    def rejected(texts: pd.Series) -> pd.Series:
        return pd.Series([model.rejects(t) for t in texts], dtype="bool")

    return docs.filter(~rejected(F.col("text")))
