"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics (``FEATURES``) are taken from the whole text.  They are
standardised and mapped to ``COMPONENTS`` random Fourier features
sqrt(2/D) cos(Wx + b), whose inner products approximate a Gaussian kernel of
width ``WIDTH``.  Ridge scores come from the normal equations: every task sums
Z'Z and Z'y over its labelled rows into one fixed-size block; blocks are added
in a tree of bounded groups; one (D+1) x (D+1) system is solved.  The raw
scores are calibrated by isotonic regression (pool adjacent violators) on
counts of labels in ``BINS`` equal steps of the raw score, so the driver sees
at most that many rows.

Learning uses every labelled row it is given, no sample.  The model is three
small arrays; its size does not depend on the data.

Defined results: a null text counts as empty and is scored like any other; a
label that is null or neither 0 nor 1 is not learned from; without any label
every score is 0.5, with labels of one class that class's share; repeated
labels of a document all count.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.llm.common import binary_texts, extended, stage

COMPONENTS = 256
WIDTH = 4.0
RIDGE = 1e-3
BINS = 2048
FAN_IN = 16
SEED = 20070101

FEATURES = ("log_bytes", "log_words", "word_length", "upper", "digit", "space", "punctuation", "symbol", "pipe",
            "shout", "beyond_ascii", "distinct_words", "top_word", "log_lines", "repeated_lines", "compressed",
            "sentence_words", "longest_word")


def byte_classes() -> np.ndarray:
    """0 other, 1 lower, 2 upper, 3 digit, 4 white space, 5 punctuation, 6 symbol, 7 pipe, 8 shout, 9 beyond ASCII."""
    out = np.zeros(256, np.uint8)
    for k, chars in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"),
                     (4, b" \t\n\r\x0b\x0c"), (5, b".,;:?'\"-()"), (6, b"#$%&*+/<=>@[\\]^_`{}~"), (7, b"|"), (8, b"!")):
        out[list(chars)] = k
    out[128:] = 9
    return out


def statistics(text: bytes | None, classes: np.ndarray) -> list[float]:
    raw = text or b""
    n = max(1, len(raw))
    kinds = np.bincount(classes[np.frombuffer(raw, np.uint8)], minlength=10)
    words = raw.split()
    w = max(1, len(words))
    counted = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = max(1, int(kinds[1] + kinds[2]))
    stops = sum(map(raw.count, (b".", b"?", b"!")))
    return [np.log1p(len(raw)), np.log1p(len(words)), (n - kinds[4]) / w, kinds[2] / letters, kinds[3] / n,
            kinds[4] / n, kinds[5] / n, kinds[6] / n, kinds[7] / n, kinds[8] / n, kinds[9] / n, len(counted) / w,
            max(counted.values(), default=0) / w, np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
            len(zlib.compress(raw, 1)) / n, np.log1p(w / (1 + stops)), np.log1p(max(map(len, counted), default=0))]


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row struct of the input's columns without the text, x array<double>): statistics of every whole text."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*keep).alias("row"), F.col(f"`{text_col}`").alias("text"))
    kind = extended(rows.select("row"), "x array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = byte_classes()
        for b in batches:
            x = np.array([statistics(t, classes) for t in binary_texts(b.column(1))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), listed(x)], names=["row", "x"])

    return rows.mapInArrow(run, kind)


def listed(x: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel(), pa.float64()))


def matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Fourier:
    """Standardise and map to random Fourier features and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, components: int = COMPONENTS, width: float = WIDTH):
        rng = np.random.Generator(np.random.Philox(SEED))
        self.mean, self.spread = mean, spread
        self.w = rng.standard_normal((len(mean), components)) / width
        self.b = rng.uniform(0, 2 * np.pi, components)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        z = np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b)
        return np.hstack([z, np.ones((len(z), 1))])


def normal_equations(labelled: DataFrame, mapping: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all labelled rows (x, y), summed per task and then in a tree."""
    d = len(mapping.b) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d + 1))
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                z = mapping(matrix(part.column(0)))
                y = part.column(1).to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                          pa.array([total.tobytes()], pa.binary())], names=["part", "block"])

    def add(members):
        members = members.sort_by("part")
        total = sum(np.frombuffer(x) for x in members.column("block").to_pylist())
        part = members.column("part").to_pylist()[0]
        return pa.table({"part": pa.array([part], pa.int64()), "block": pa.array([total.tobytes()], pa.binary())})

    blocks = stage(labelled.select("x", "y").mapInArrow(sums, "part long, block binary"))
    while (n := blocks.count()) > FAN_IN:
        groups = -(-n // FAN_IN)
        blocks = stage(blocks.groupBy(F.pmod("part", F.lit(groups)).alias("g")).applyInArrow(
            add, "part long, block binary"))
    total = np.zeros((d, d + 1))
    for r in blocks.orderBy("part").collect():
        total += np.frombuffer(r["block"]).reshape(d, d + 1)
    return total[:, :d], total[:, d]


def isotonic(position: np.ndarray, ones: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: non-decreasing shares of ones, at the mean position of each pool."""
    pools: list[list[float]] = []
    for x, s, n in zip(position, ones, count):
        pools.append([x * n, float(s), float(n)])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return (np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools]))


class Model:
    def __init__(self, mapping: Fourier | None, weights: np.ndarray, at: np.ndarray, share: np.ndarray):
        self.mapping, self.weights, self.at, self.share = mapping, weights, at, share

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.mapping(x) @ self.weights, -0.5, 1.5)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.mapping is None:
            return np.full(len(x), self.share[0])
        return np.interp(self.raw(x), self.at, self.share)


def fit(labelled: DataFrame, components: int = COMPONENTS, width: float = WIDTH, ridge: float = RIDGE) -> Model:
    """Fit on all rows (x array<double>, y 0 or 1)."""
    k = len(FEATURES)
    row = labelled.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("share"),
                       *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)],
                       *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k)]).first()
    if not row["n"] or row["share"] in (0.0, 1.0):
        return Model(None, np.zeros(0), np.zeros(1), np.array([0.5 if not row["n"] else row["share"]]))
    spread = np.array([row[f"s{i}"] for i in range(k)])
    mapping = Fourier(np.array([row[f"m{i}"] for i in range(k)]), np.where(spread > 1e-9, spread, 1.0), components,
                      width)
    a, v = normal_equations(labelled, mapping)
    weights = np.linalg.solve(a + ridge * row["n"] / len(v) * np.eye(len(v)), v)
    model = Model(mapping, weights, np.zeros(1), np.zeros(1))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            steps = np.floor((model.raw(matrix(b.column(0))) + 0.5) / 2 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(steps), b.column(1)], names=["step", "y"])

    counts = labelled.select("x", F.col("y").cast("long").alias("y")).mapInArrow(binned, "step long, y long")
    rows = sorted(counts.groupBy("step").agg(F.sum("y").alias("s"), F.count(F.lit(1)).alias("n")).collect())
    model.at, model.share = isotonic(np.array([(r["step"] + 0.5) / BINS * 2 - 0.5 for r in rows]),
                                     np.array([r["s"] for r in rows]), np.array([r["n"] for r in rows]))
    return model


def score(rows: DataFrame, model: Model) -> DataFrame:
    """Add (score double) to rows (row struct, x array<double>)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(matrix(b.column(1))), pa.float64())],
                                             names=["row", "score"])

    return rows.select("row", "x").mapInArrow(run, extended(rows.select("row"), "score double"))


def classify(docs: DataFrame, labels: DataFrame, learn_from, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """Fit on the labelled documents for which ``learn_from(id column)`` holds, score all documents.

    Returns (row struct of the input's columns without the text, score double).
    """
    rows = stage(features(docs, text_col))
    known = labels.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{label_col}`").cast("int").alias("y")).where(
        F.col("y").isin(0, 1) & learn_from(F.col("label_id")))
    labelled = stage(rows.select(F.col(f"row.`{id_col}`").alias("i"), "x").join(
        known, F.col("i") == F.col("label_id")).select("x", "y"))
    return score(rows, fit(labelled))
