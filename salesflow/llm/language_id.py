"""Language identification in two steps: family first, then the language within it.

A text becomes counts of hashed byte 1- to 3-grams (letters lower-cased, everything that
is no letter a space), square-rooted and scaled to length one, over the whole text. One
linear support vector machine per pair of families votes for the family; one per pair of
its languages votes for the language. Machines are trained by dual coordinate descent on
a sample of labelled rows, bounded by ``per_language`` and ``sample_rows``; everything else
reads all rows.

Null text and text without a letter is ``und`` with score 0, as is every text when nothing
was learned. Rows without a label or id, or with null or unusable text, teach nothing.
Repeated rows get equal answers. An empty table gives no rows. The prediction comes as one
struct column of the caller's name, so no other column is touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Families of languages by their codes; a language outside is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "indic": "hi mr ne bn pa gu ur sd",
    "semitic": "ar he mt am",
    "turkic": "tr az kk uz tt ky",
    "uralic": "fi et hu",
    "sinitic": "zh yue",
}
UNKNOWN = "und"
PER_LANGUAGE = 400
SAMPLE_ROWS = 4000
MOST_LABELS = 1000
BINS = (1 << 8, 1 << 12, 1 << 13)
CHUNK_BYTES = 1 << 20
TEXTS_AT_ONCE = 128
#: Margin to score: a margin of 1 gives 0.95.
SLOPE = 3.0

_LETTER = np.full(256, ord(" "), np.uint8)
for _b in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
    _LETTER[_b] = _b
_OFFSETS = np.cumsum([0, *BINS])
SIZE = int(_OFFSETS[-1])


def family(language: str) -> str:
    for name, codes in FAMILIES.items():
        if language.lower().split("-")[0] in codes.split():
            return name
    return language


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """The feature vector of a whole text; long texts are counted in chunks."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(SIZE, np.float32)
    for lo in range(0, max(len(raw) - 2, 1), CHUNK_BYTES):
        b = _LETTER[raw[lo : lo + CHUNK_BYTES + 2]].astype(np.uint32)
        # Runs of spaces count as one.
        b = b[np.r_[True, (b[1:] != 32) | (b[:-1] != 32)]] if len(b) else b
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        for gram, bins, at in zip((b[1:-1], two[1:], three), BINS, _OFFSETS, strict=False):
            where = gram if bins == 256 else gram * np.uint32(2654435761) >> np.uint32(32 - bins.bit_length() + 1)
            counts[at : at + bins] += np.bincount(where, minlength=bins)
    counts[32] = 0
    for at, bins in zip(_OFFSETS, BINS, strict=False):
        part = np.sqrt(counts[at : at + bins])
        norm = np.linalg.norm(part)
        counts[at : at + bins] = part / norm if norm else part
    return counts / np.float32(np.sqrt(len(BINS)))


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine with squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    order = np.random.default_rng(0)
    # Rare sides weigh more.
    cost = c * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    slack = 0.5 / cost
    square = (x * x).sum(1) + slack
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1], np.float32)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            g = y[i] * (x[i] @ w) - 1 + slack[i] * alpha[i]
            new = max(alpha[i] - g / square[i], 0.0)
            if step := new - alpha[i]:
                w += np.float32(step * y[i]) * x[i]
                alpha[i] = new
                moved = max(moved, abs(g))
        if moved < 1e-3:
            break
    return w


class Machines:
    """One machine per pair of classes; the class with most votes wins, then the larger sum of margins."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.names = sorted(set(labels))
        self.pairs = list(combinations(range(len(self.names)), 2))
        rows = []
        for a, b in self.pairs:
            of = np.flatnonzero((labels == self.names[a]) | (labels == self.names[b]))
            rows.append(svm(x[of], np.where(labels[of] == self.names[a], 1.0, -1.0)))
        self.weights = np.array(rows, np.float32).reshape(len(rows), x.shape[1] + 1)

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the winner, its smallest margin against another class) per row."""
        if not self.pairs:
            return np.zeros(len(x), int), np.full(len(x), np.inf)
        margins = x.astype(np.float64) @ self.weights[:, :-1].T + self.weights[:, -1]
        votes = np.zeros((len(x), len(self.names)))
        least = np.full_like(votes, np.inf)
        for k, (a, b) in enumerate(self.pairs):
            m = margins[:, k]
            # A vote outweighs all margins, which only break ties.
            for side, s in ((a, m), (b, -m)):
                votes[:, side] += (s > 0) + 1e-3 * np.tanh(s)
                least[:, side] = np.minimum(least[:, side], s)
        best = votes.argmax(1)
        return best, least[np.arange(len(x)), best]


class Model:
    def __init__(self, x: np.ndarray, languages: list[str]):
        labels = np.array(languages, object)
        families = np.array([family(s) for s in languages], object)
        self.families = Machines(x, families)
        self.languages = {f: Machines(x[families == f], labels[families == f]) for f in set(families)}

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        which, margin = self.families.decide(x)
        out = np.empty(len(x), object)
        for k in np.unique(which):
            rows = which == k
            machines = self.languages[self.families.names[k]]
            best, inner = machines.decide(x[rows])
            out[rows] = np.array(machines.names, object)[best]
            margin[rows] = np.minimum(margin[rows], inner)
        # Rounded, so that equal texts agree wherever they stand in a batch.
        return out.tolist(), np.round(1 / (1 + np.exp(-SLOPE * margin)), 5)


def fit(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    per_language: int = PER_LANGUAGE,
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """Train on about ``per_language`` texts of each label, picked by a hash of id and text.

    Equal texts of one id count once, so every label has some. Only the feature vectors of the
    sample reach the driver: at most ``2 * per_language`` per label, which Spark sees to, and with
    many labels fewer each, ``sample_rows`` over all. More than ``MOST_LABELS`` labels are an error.
    """
    rows = df.where(F.col(text).isNotNull() & F.col(label).isNotNull() & F.col(id).isNotNull())
    place = F.xxhash64(F.col(id), F.col(text), F.lit("language sample"))
    labelled = rows.select(F.col(label).alias("label"), F.col(text).alias("text"), place.alias("place"))
    sizes = labelled.groupBy("label").agg(F.approx_count_distinct("place").alias("n"))
    counts = {r[0]: r[1] for r in sizes.limit(MOST_LABELS + 1).collect()}
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels in {label}: no column of languages")
    if not counts:
        return None
    per_language = max(4, min(per_language, sample_rows // len(counts)))
    share = F.create_map(
        *[F.lit(v) for k, n in counts.items() for v in (k, int(min(1.0, per_language / n) * (1 << 30)))]
    )
    chosen = labelled.where(F.pmod("place", F.lit(1 << 30)) < share[F.col("label")]).dropDuplicates(["label", "place"])
    first = Window.partitionBy("label").orderBy("place")
    bounded = chosen.withColumn("k", F.row_number().over(first)).where(F.col("k") <= 2 * per_language)
    sample = bounded.select("text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (a, features(t).astype(np.float16).tobytes())
                for t, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                if has_letter(t)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary())],
                ["label", "x"],
            )

    kept = sample.mapInArrow(run, "label string, x binary").collect()
    kept.sort(key=lambda r: (r[0], bytes(r[1])))
    kinds = [r[0] for r in kept]
    vectors = [np.frombuffer(r[1], np.float16) for r in kept]
    return Model(np.array(vectors, np.float32), kinds) if kinds else None


def predict(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """A struct column (lang, score) for a text column."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang = [UNKNOWN] * len(texts)
            score = np.zeros(len(texts))
            usable = [k for k, t in enumerate(texts) if has_letter(t)]
            for lo in range(0, len(usable), TEXTS_AT_ONCE):
                rows = usable[lo : lo + TEXTS_AT_ONCE]
                names, sure = shared.value.predict(np.array([features(texts.iat[k]) for k in rows]))
                for k, name in zip(rows, names, strict=True):
                    lang[k] = name
                score[rows] = sure
            yield pd.DataFrame({"lang": lang, "score": score})

    # A filter on the answer must not evaluate the function a second time.
    return run.asNondeterministic()(text)
