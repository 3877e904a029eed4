"""Quality of documents by co-training two views.

One view is the text's content: hashed letter and sign trigrams.  The other is what is known about
the page without reading it: source, declared language, size, and the shape of the text (lines,
kinds of characters, repeated words).  Each view has a logistic classifier, fitted on labelled rows.
In every round all other rows are scored by both, and every guess of CONFIDENT certainty is a label for
the other view, which is fitted anew to these and the labelled rows.  On labelled rows kept aside, the
views' log odds are then calibrated and combined, by a logistic fit on both; with these weights all
documents are scored.

What a round learns from the guesses is a sum over all rows, the slope of their log loss at the weights
before.  The fit takes the curvature from the labelled rows and corrects their slope by the difference
to that of all rows (surrogate likelihood), so one pass a round reads every row and holds none.

The driver holds only the features of LABELLED rows with labels, taken by a hash of the id, of whatever
size their texts are; features are computed in tasks.  Other labelled rows count as rows without a label.

Cases: null is the empty text; null source, language and id are values like others; labels other
than 0 and 1 and rows without a document are left out of the fit; without labels of both kinds every
score is the share of good labels, 1 without any; repeated rows give repeated rows; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import pieces, schema_with, texts, with_columns

LABELLED = 3000
#: Texts whose features are computed at a time.
PART = 128
ROUNDS = 3
#: The least confidence of a guess that a view hands over.
CONFIDENT = 0.95
#: What holds the weights of a round to those before, where the labelled rows have little curvature.
NEAR = 0.05
#: Partial sums of tasks that one task adds up.
FAN = 32
CONTENT_BITS = 11
CONTENT = 1 << CONTENT_BITS
#: Hashed values of source and language, and steps of each number of the metadata view.
NAMED = 128
STEPS = 12
_SHAPE = ("size", "lines", "letters", "capitals", "digits", "spaces", "signs", "distinct words", "distinct lines", "word length")
METADATA = NAMED + len(_SHAPE) * STEPS
KEEP_FROM = 0.5

RESULT = {"content_score": "double", "metadata_score": "double", "score": "double", "keep": "boolean"}


class Views(NamedTuple):
    content: np.ndarray  # weights with the bias last
    metadata: np.ndarray
    stack: np.ndarray  # of the log odds of content and metadata, and a constant
    calibration: np.ndarray  # for each view: slope and constant
    prior: float | None  # the score of all rows, if there was nothing to learn from


def _kinds() -> np.ndarray:
    """0 other signs, 1 lower-case and other letters, 2 capitals, 3 digits, 4 spaces, 5 line ends."""
    out = np.zeros(1 << 16, np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        out[i] = 5 if c == "\n" else 4 if c.isspace() else 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 0
    return out


_KINDS: list[np.ndarray] = []


def _codes(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(batch).encode("utf-32-le", "replace"), np.uint32)
    return codes, np.repeat(np.arange(len(batch)), [len(t) for t in batch])


def content_features(batch: list[str]) -> np.ndarray:
    """For each text the square roots of its shares of hashed trigrams."""
    codes, owner = _codes(batch)
    if len(codes) < 3:
        return np.zeros((len(batch), CONTENT), np.float32)
    a, b, c = codes[:-2], codes[1:-1], codes[2:]
    mixed = a * np.uint32(2654435761) ^ b * np.uint32(2246822519) ^ c * np.uint32(3266489917)
    mixed ^= mixed >> np.uint32(15)
    bucket = (mixed * np.uint32(2654435761)) >> np.uint32(32 - CONTENT_BITS)
    whole = owner[:-2] == owner[2:]
    cells = owner[:-2][whole] * CONTENT + bucket[whole]
    counts = np.bincount(cells, minlength=len(batch) * CONTENT).reshape(len(batch), CONTENT).astype(np.float32)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def metadata_features(batch: list[str], source: list, lang: list) -> np.ndarray:
    """Source and language hashed, and every number of the shape as the step it falls in."""
    if not _KINDS:
        _KINDS.append(_kinds())
    codes, owner = _codes(batch)
    kind = np.where(codes < 1 << 16, _KINDS[0][np.minimum(codes, (1 << 16) - 1)], 1)
    counts = np.bincount(owner * 6 + kind, minlength=6 * len(batch)).reshape(-1, 6).astype(float)
    size = np.maximum(counts.sum(axis=1), 1)
    letters = np.maximum(counts[:, 1] + counts[:, 2], 1)
    words = [t.split() for t in batch]
    lines = [t.split("\n") for t in batch]
    n_words = np.array([max(1, len(w)) for w in words])
    shape = np.stack(
        [
            np.log2(size) / 20,
            np.log2(1 + counts[:, 5]) / 12,
            letters / size,
            counts[:, 2] / letters,
            np.sqrt(counts[:, 3] / size),
            np.sqrt(counts[:, 4] / size),
            np.sqrt(counts[:, 0] / size),
            np.array([len(set(w)) for w in words]) / n_words,
            np.array([len(set(x)) / len(x) for x in lines]),
            size / n_words / 20,
        ],
        axis=1,
    )
    step = np.clip((shape * STEPS).astype(int), 0, STEPS - 1)
    out = np.zeros((len(batch), METADATA), np.float32)
    rows = np.arange(len(batch))
    for name, values in (("source", source), ("lang", lang)):
        out[rows, [crc32(f"{name}={v}".encode()) % NAMED for v in values]] = 1
    for i in range(shape.shape[1]):
        out[rows, NAMED + i * STEPS + step[:, i]] = 1
    return out


def _odds(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return x @ weights[:-1].astype(x.dtype) + weights[-1]


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def _slope(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The slope of the summed log loss."""
    miss = _chance(_odds(x, weights)) - y
    return np.append(miss.astype(x.dtype) @ x, miss.sum()).astype(np.float64)


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, rounds: int = 80, rate: float = 0.5, tilt: np.ndarray | float = 0.0, near: np.ndarray | None = None) -> np.ndarray:
    """Weights of least regularised log loss, by gradient steps of their own size for each weight.

    The tilt is added to the slope, and NEAR times the distance from the weights to stay near.
    """
    weights, seen = np.zeros(x.shape[1] + 1), np.full(x.shape[1] + 1, 1e-8)
    for _ in range(rounds):
        slope = (_slope(x, y, weights) + decay * np.append(weights[:-1], 0)) / len(y) + tilt
        if near is not None:
            slope += NEAR * (weights - near)
        seen += slope**2
        weights -= rate * slope / np.sqrt(seen)
    return weights


def _features(batch: pa.RecordBatch) -> list[np.ndarray]:
    t = texts(batch, "t")
    return [content_features(t), metadata_features(t, batch.column("s").to_pylist(), batch.column("l").to_pylist())]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "t"):
            for a in range(0, piece.num_rows, PART):
                yield piece.slice(a, PART)


def guessed_slopes(rows: DataFrame, chosen: set, weights: list[np.ndarray]) -> list[tuple[np.ndarray, int]]:
    """For each view the slope of the log loss over all rows that the other view is sure of, and their number.

    Rows with a chosen key are left out.
    """
    spread = rows.sparkSession.sparkContext.broadcast((chosen, weights))
    kinds = pa.schema([("part", pa.int64()), ("payload", pa.binary())])
    ends = np.cumsum([len(w) + 1 for w in weights])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, weights = spread.value
        total = np.zeros(ends[-1])
        for part in _parts(batches):
            free = np.array([k not in chosen for k in part.column("key").to_pylist()])
            views = _features(part)
            odds = [_odds(x, w) for x, w in zip(views, weights, strict=True)]
            for pupil, teacher in ((0, 1), (1, 0)):
                chance = _chance(odds[teacher])
                sure = free & (np.maximum(chance, 1 - chance) >= CONFIDENT)
                slope = _slope(views[pupil][sure], (chance[sure] > 0.5).astype(float), weights[pupil])
                total[ends[pupil] - len(slope) - 1 : ends[pupil]] += np.append(slope, sure.sum())
        yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "payload": [total.tobytes()]}, schema=kinds)

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())  # the same order, the same sum
        total = sum(np.frombuffer(table.column("payload")[int(i)].as_py()) for i in order)
        return pa.Table.from_pydict({"part": [int(table.column("part").to_numpy().min())], "payload": [total.tobytes()]}, schema=kinds)

    sums = rows.mapInArrow(run, "part bigint, payload binary")
    sums = sums.groupBy(F.pmod("part", F.lit(FAN)).alias("of")).applyInArrow(add, "part bigint, payload binary")
    found = sorted(sums.collect(), key=lambda r: r["part"])
    total = sum((np.frombuffer(r["payload"]) for r in found), np.zeros(ends[-1]))
    return [(v[:-1], int(v[-1])) for v in np.split(total, ends[:-1])]


def co_train(views: list[np.ndarray], labels: np.ndarray, rows: DataFrame, chosen: set, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The weights of both views after they have taught each other with all rows that are not chosen."""
    weights = [fit_logistic(x, labels) for x in views]
    for _ in range(rounds):
        taught = guessed_slopes(rows, chosen, weights)
        fitted = []
        for x, w, (slope, n) in zip(views, weights, taught, strict=True):
            own = _slope(x, labels, w)
            fitted.append(fit_logistic(x, labels, tilt=(own + slope) / (len(labels) + n) - own / len(labels), near=w))
        weights = fitted
    return weights


def learn(documents: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", label: str = "quality", aside: float = 0.25) -> Views:
    """Fit on a bounded sample of the labelled documents and on all others."""
    rows = documents.select(F.col(id).alias("key"), F.col(text).alias("t"), F.col(source).cast("string").alias("s"), F.col(lang).cast("string").alias("l"))
    place = F.xxhash64("key", F.lit("sample"))
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id).alias("key")).agg(F.max(label).alias("y"))
    # The least hashes of the labelled ids that have documents; their features come by a join with few rows.
    known = known.join(rows.select("key").distinct(), "key", "left_semi")
    wanted = known.orderBy(place, "key").limit(LABELLED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            views = [pa.array([row.tobytes() for row in x], pa.binary()) for x in _features(part)]
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("y"), *views], names=["key", "y", "content", "metadata"])

    sample = rows.join(F.broadcast(wanted), "key").select("key", F.col("y").cast("bigint").alias("y"), "t", "s", "l")
    sample = sample.mapInArrow(run, schema_with(sample, ["key", "y"], {"content": "binary", "metadata": "binary"}))
    found = sample.orderBy(place, "key", "content", "metadata").limit(2 * LABELLED).collect()
    y = np.array([r["y"] for r in found], float)
    if len(set(y)) < 2:
        return Views(np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0), float(np.mean(y)) if len(y) else 1.0)
    both = [np.stack([np.frombuffer(r[c], np.float32) for r in found]) for c in ("content", "metadata")]
    chosen = {r["key"] for r in found}
    del found
    held = np.arange(1, len(y) + 1) % round(1 / aside) == 0
    if len(set(y[~held])) < 2:
        held[:] = False
    fitting = ~held
    held = held if held.any() else fitting
    weights = co_train([x[fitting] for x in both], y[fitting], rows, chosen)
    odds = np.stack([_odds(x[held], w) for x, w in zip(both, weights, strict=True)], axis=1)
    calibration = np.stack([fit_logistic(odds[:, i : i + 1], y[held], 0.1, 400) for i in range(2)])
    stack = fit_logistic(odds, y[held], 0.1, 400)
    return Views(weights[0], weights[1], stack, calibration, None)


def score(documents: DataFrame, views: Views, text: str = "text", source: str = "source", lang: str = "lang", keep_text: bool = True) -> DataFrame:
    """The documents with the calibrated score of each view, the combined score, and keep."""
    kept = [c for c in documents.columns if c not in RESULT and (keep_text or c != text)]
    spread = documents.sparkSession.sparkContext.broadcast(views)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = spread.value
        for batch in batches:
            for piece in pieces(batch, text):
                # a part has few rows, so that the feature matrix is small
                for a in range(0, piece.num_rows, 1024):
                    part = piece.slice(a, 1024)
                    if v.prior is not None:
                        scores = [np.full(part.num_rows, v.prior)] * 3
                    else:
                        t = texts(part, text)
                        odds = np.stack(
                            [
                                _odds(content_features(t), v.content),
                                _odds(metadata_features(t, part.column(source).to_pylist(), part.column(lang).to_pylist()), v.metadata),
                            ],
                            axis=1,
                        )
                        scores = [_chance(_odds(odds[:, i : i + 1], v.calibration[i])) for i in range(2)] + [_chance(_odds(odds, v.stack))]
                    scores = [np.round(s, 9) for s in scores]
                    columns = dict(zip(RESULT, [*map(pa.array, scores), pa.array(scores[2] >= KEEP_FROM)], strict=True))
                    yield with_columns(part.select(kept), columns)

    return documents.mapInArrow(run, schema_with(documents, kept, RESULT))
