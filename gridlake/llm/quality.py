"""Quality classifier: naive Bayes support vectors over hashed n-gram indicators.

1. Every labelled training row is turned into the set of its hashed token
   unigrams and bigrams.  Document counts per feature and label are summed over
   *all* training rows; their smoothed log ratio ``r`` scales the indicators.
2. A linear model with hinge loss is fitted to the scaled, length-normalised
   indicators by dual coordinate descent, on at most ``FIT_ROWS`` training rows
   (those with the smallest hash of their text, equal texts by label; the documented
   bound of the fit).  Margins of held-back folds calibrate it to probabilities.
3. Every whole text is scored in one pass; the model is ``FEATURES`` numbers,
   whatever the corpus.

Tokens are runs of word bytes (letters, digits, all non-ASCII bytes) or runs of
other visible bytes.  Besides the tokens themselves there are abstract n-grams
that say how often a token comes again next or after next, so repetition of any
token is seen.  Only texts and the labels of training rows enter a score: ids
neither choose nor order the rows of the fit, so other ids give the same scores.

Cases: null and empty texts have no features and get the score of the
intercept; a text of any length is scored whole; rows without a label (or a label other than 0 and 1) are only
scored; repeated labelled rows each count; with no training rows of both labels
every score is the share of label 1 (0.5 without rows).  Other columns are
ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textnum import U64, mix, runs, slices, span_hashes

FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
FIT_ROWS = 16_000
SMOOTH = 1.0
MIN_DOCS = 3           # features of fewer training rows are left out
FOLDS = 5              # margins for the calibration come from models that did not see the row
COST = 1.0
EPOCHS = 12


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    t = np.full(256, 2, np.uint8)
    t[:0x21] = 0
    t[0x7F] = 0
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        t[a:b] = 1
    return t


def features(data: np.ndarray, offsets: np.ndarray):
    """Distinct ``(text number, feature)`` pairs, ordered, of a slice of texts."""
    starts, ends, text = runs(_kinds()[data], offsets)
    h = span_hashes(data, starts, ends)
    shift = U64(64 - FEATURE_BITS)
    with np.errstate(over="ignore"):
        pair = mix(h[:-1] * U64(0xC2B2AE3D27D4EB4F) + h[1:])
    same = text[:-1] == text[1:]
    found = [h >> shift, pair[same] >> shift]
    owner = [text, text[:-1][same]]
    # Abstract n-grams: "the same token again", one and two tokens on.  Their share
    # of a text, in eighths, is an indicator each.
    n = np.maximum(np.bincount(text, minlength=len(offsets) - 1), 1)
    for lag in (1, 2):
        again = (h[lag:] == h[:-lag]) & (text[lag:] == text[:-lag])
        share = np.bincount(text[lag:][again], minlength=len(n)) * 8 // n
        mark = mix((share + 16 * lag).astype(U64)) >> shift
        has = np.flatnonzero(np.bincount(text, minlength=len(n)))
        found.append(mark[has]), owner.append(has)
    found = np.concatenate(found).astype(np.int64)
    owner = np.concatenate(owner)
    keys = np.unique((owner << FEATURE_BITS) | found)
    return keys >> FEATURE_BITS, keys & (FEATURES - 1)


def _feature_sets(batches):
    """(label, pick, text) -> (label, pick, features as u32 bytes, each less the one before)."""
    for batch in batches:
        sets = []
        for _, data, offsets in slices(batch["text"]):
            text, feat = features(data, offsets)
            cuts = np.searchsorted(text, np.arange(len(offsets)))
            f = feat.astype("<u4")
            sets += [np.diff(f[a:b], prepend=f[:1] * 0).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch["label"], batch["pick"], pa.array(sets, pa.binary())],
                                         names=["label", "pick", "feats"])


def _unpack(raw) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4"), dtype=np.int64)


def _count(batches):
    """Sum feature counts per label over a task's rows before anything is shuffled."""
    total = np.zeros((2, FEATURES), np.int64)
    for batch in batches:
        for y, f in zip(batch["label"].to_numpy(), batch["feats"]):
            total[y][_unpack(f.as_py())] += 1      # a set: no feature twice
    used = np.flatnonzero(total.any(axis=0))
    for a in range(0, len(used), 50_000):
        u = used[a:a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(total[0, u]), pa.array(total[1, u])],
                                         names=["feature", "n0", "n1"])


def dual_coordinate_descent(rows: list, y: np.ndarray, scale: np.ndarray, cost: np.ndarray,
                            epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Hinge-loss weights (last entry: intercept) for indicator sets ``rows``.

    Row i is ``scale`` at its features divided by its length, plus a constant 1.
    """
    w = np.zeros(len(scale) + 1)
    values = []
    for f in rows:
        x = scale[f]
        norm = np.sqrt((x * x).sum())
        values.append(x / norm if norm else x)
    square = np.array([1.0 + float((x * x).sum()) for x in values])
    alpha = np.zeros(len(rows))
    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        moved = 0.0
        for i in order:
            f, x = rows[i], values[i]
            gradient = y[i] * (x @ w[f] + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[f] += step * x
                w[-1] += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def _sigmoid_fit(margin: np.ndarray, y01: np.ndarray):
    """Platt's a, b of 1 / (1 + exp(-(a * margin + b))), by Newton steps with smoothed targets."""
    n1, n0 = y01.sum(), (1 - y01).sum()
    target = np.where(y01 == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum() + 1e-3 * b])
        v = p * (1 - p) + 1e-9
        hess = np.array([[(v * margin * margin).sum() + 1e-3, (v * margin).sum()],
                         [(v * margin).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _margins(rows: list, scale: np.ndarray, w: np.ndarray) -> np.ndarray:
    out = np.full(len(rows), w[-1])
    for i, f in enumerate(rows):
        x = scale[f]
        norm = np.sqrt((x * x).sum())
        if norm:
            out[i] += (x @ w[f]) / norm
    return out


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Model of ``labelled(text, label)``; see the module's text.

    Only ``FEATURES`` sums and the fitted weights come to the driver.
    """
    rows = (labelled.where(F.col("label").isin(0, 1))
            .select(F.col("label").cast("int").alias("label"),
                    F.xxhash64("text").alias("pick"),
                    F.coalesce("text", F.lit("")).cast("binary").alias("text")))
    sets = stored(rows.mapInArrow(_feature_sets, "label int, pick bigint, feats binary"), "nbsvm-sets")
    n = {r["label"]: r["count"] for r in sets.groupBy("label").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.5
        return {"constant": share}
    sums = (sets.mapInArrow(_count, "feature bigint, n0 bigint, n1 bigint")
            .groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas())
    c = np.zeros((2, FEATURES))
    c[0, sums["feature"]], c[1, sums["feature"]] = sums["n0"], sums["n1"]
    p1, p0 = SMOOTH + c[1], SMOOTH + c[0]
    scale = np.log((p1 / p1.sum()) / (p0 / p0.sum()))
    scale[(c[0] + c[1]) < MIN_DOCS] = 0.0
    share = min(1.0, fit_rows / (n0 + n1))
    bound = int(share * (1 << 63)) - 1
    sample = sets.where(F.expr("pick & 9223372036854775807") <= bound).orderBy("pick", "label").limit(fit_rows)

    def solve(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("pick", "ascending"), ("feats", "ascending"), ("label", "ascending")])
        sets_ = [_unpack(f.as_py()) for f in rows["feats"]]
        y01 = rows["label"].to_numpy()
        y = np.where(y01 == 1, 1.0, -1.0)
        # both labels weigh the same in the loss
        share1 = min(max(y01.mean(), 1e-6), 1 - 1e-6)
        cost = np.where(y01 == 1, 0.5 / share1, 0.5 / (1 - share1)) * COST

        def weights(rows):
            return dual_coordinate_descent([sets_[i] for i in rows], y[rows], scale, cost[rows])

        every = np.arange(len(y01))
        margin = np.empty(len(y01))
        for k in range(FOLDS):
            out = every[every % FOLDS == k]
            w = weights(every[every % FOLDS != k])
            margin[out] = _margins([sets_[i] for i in out], scale, w)
        a, b = _sigmoid_fit(margin, y01)
        w = weights(every)
        return pa.table({"w": pa.array([w.astype("<f8").tobytes()], pa.binary()), "a": [a], "b": [b]})

    out = sample.groupBy(F.lit(0).alias("model")).applyInArrow(solve, "w binary, a double, b double").first()
    return {"scale": scale.astype(np.float32), "w": np.frombuffer(out["w"], "<f8").astype(np.float32),
            "a": out["a"], "b": out["b"]}


def _scores(texts, n_rows: int, model: dict) -> np.ndarray:
    scale, w = model["scale"], model["w"]
    product, square = scale * w[:-1], scale * scale
    score = np.empty(n_rows)
    for at, data, offsets in slices(texts):
        n = len(offsets) - 1
        text, feat = features(data, offsets)
        dot = np.bincount(text, product[feat], n)
        norm = np.sqrt(np.bincount(text, square[feat], n))
        margin = dot / np.where(norm > 0, norm, 1.0) + w[-1]
        score[at:at + n] = 1 / (1 + np.exp(-np.clip(model["a"] * margin + model["b"], -30, 30)))
    return score


def score_column(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, score)``, one row per row, in one narrow pass."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    if "constant" in model:
        return plain.select("doc_id", F.lit(float(model["constant"])).alias("score"))

    def run(batches):
        for batch in batches:
            score = _scores(batch["text"], batch.num_rows, model)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], names=["doc_id", "score"])

    return plain.mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; all columns stay, nothing is shuffled but the fit."""
    model = fit(training_rows(docs, labels), fit_rows)
    if "constant" in model:
        return docs if model["constant"] >= threshold else docs.limit(0)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            text = batch.column(at).cast(pa.binary())
            if text.null_count:
                text = text.fill_null(b"")
            yield batch.filter(pa.array(_scores(text, batch.num_rows, model) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id="doc_id"):
    """Rows whose crc32 of the id's text leaves 0 modulo 5 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows outside the held-out fold.

    The labels are hashed, never the texts sorted, and the join is the same
    shuffle at every size, as labels grow with the corpus.
    """
    marks = labels.select("doc_id", F.col("quality").alias("label")).where("doc_id is not null and label in (0, 1)")
    return (docs.where(~held_out()).select("doc_id", "text")
            .join(marks.where(~held_out()).hint("shuffle_hash"), "doc_id"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted (score >= threshold)."""
    model = fit(training_rows(docs, labels), fit_rows)
    return (score_column(docs, model)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
