"""Quality classifier by positive-unlabelled learning.

Trusted positives P are labelled texts with label 1, unlabelled texts U are web
text drawn without regard to labels. The classifier g minimises the non-negative
unbiased risk

    pi * mean_P loss(g) + max(0, mean_U loss(-g) - pi * mean_P loss(-g))

with the logistic loss, so sigmoid(g) estimates the chance that the label is 1; when
the second part turns negative its gradient is reversed, which keeps g from fitting
U as negative outright. g is a network with one hidden layer over figures of the
whole text's form (letters, symbols, case, repetition, word and line lengths).

The class prior pi is estimated from P and U alone: a logistic regression of
P against U gives the density ratio p(x | 1) / p(x), which is 1 / pi wherever texts
are certainly positive, so pi is the inverse of its median over P. Negative labels are
not used.

Features of all texts of U are written once, 22 figures a text, and everything that is
fitted minimises the risk over all of them: their moments; the density ratio behind the prior,
by Newton steps; both layers together, by a quasi-Newton descent. A pass sums loss and
derivatives by task. Sums of the descent are of whole numbers (multiples of 2^-30), so they do not
depend on how rows are dealt to tasks. Only the labelled texts P are bounded: about
``MAX_FIT`` of them at most are taken, by a hash of id and text. As many texts of U give
the descent its first point, no more. A fit that does not converge within its
passes says so in a warning and in ``Model.converged``.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import bound_batches
from .scratch import Scratch

THRESHOLD = 0.7
MAX_FIT = 20_000
HIDDEN = 16
STEPS = 1500
BATCH = 1024
SEED = 20
WINDOW = 50
PASSES = 50
DESCENT = 60
TOLERANCE = 1e-5

N_FEATURES = 22
_SYMBOLS = "%&#$*@^~<>{}[]\\/=+_"
_UPPER, _LOWER, _DIGIT, _SPACE, _BREAK, _STOP, _COMMA, _BANG, _BAR, _SYM, _OTHER = range(11)


def _classes() -> np.ndarray:
    table = np.full(0x110000, _OTHER, dtype=np.uint8)
    for c in range(0x3000):
        x = chr(c)
        if x.isupper():
            table[c] = _UPPER
        elif x.isalpha():
            table[c] = _LOWER
        elif x.isdigit():
            table[c] = _DIGIT
        elif x in "\n\r":
            table[c] = _BREAK
        elif x.isspace():
            table[c] = _SPACE
    table[0x3000:0xD800] = _LOWER
    for chars, k in ((".:;?", _STOP), (",'\"()-", _COMMA), ("!", _BANG), ("|", _BAR), (_SYMBOLS, _SYM)):
        for x in chars:
            table[ord(x)] = k
    return table


_TABLE = _classes()


def features(text: str | None) -> np.ndarray:
    """Figures of a whole text's form; zeros for null or blank text."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    words = (text or "").split()
    if not words:
        return out
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(_TABLE[codes], minlength=11).astype(np.float64)
    n, w = len(codes), len(words)
    letters = max(1.0, kinds[_UPPER] + kinds[_LOWER])
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=w)
    blocks = [words[k : k + WINDOW] for k in range(0, w, WINDOW)]
    fresh = sum(len(set(b)) for b in blocks) / w
    again = sum(map(str.__eq__, words, words[1:])) / w
    lines = [x for x in text.split("\n") if x.strip()]
    caps = sum(map(str.isupper, words)) / w
    tails = sum(1 for x in words if not x[-1].isalnum()) / w
    out[:] = (
        kinds[_UPPER] / letters, kinds[_DIGIT] / n, kinds[_SPACE] / n, kinds[_STOP] / w, kinds[_COMMA] / w,
        kinds[_BANG] / w, kinds[_BAR] / w, kinds[_SYM] / w, kinds[_OTHER] / n, letters / n,
        caps, tails, fresh, again, len(set(words)) / w,
        lengths.mean(), lengths.std(), np.log1p(lengths.max()), np.log1p(w), w / len(lines),
        len(set(lines)) / len(lines), kinds[_BREAK] / w,
    )
    for k in (3, 4, 5, 6, 7):
        out[k] = np.sqrt(out[k])
    out[19] = np.log1p(out[19])
    return out


def _matrix(texts) -> np.ndarray:
    return np.stack([features(x) for x in texts]) if len(texts) else np.zeros((0, N_FEATURES), np.float32)


@dataclass(frozen=True)
class Model:
    """A fitted classifier: standardisation, two layers and the prior it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float
    passes: int = 0
    converged: bool = True

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        g = np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _moments(u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return u.mean(0), np.where(u.std(0) < 1e-6, 1.0, u.std(0))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _ratio_weights(p: np.ndarray, u: np.ndarray, steps: int = 300) -> np.ndarray:
    """Weights of a logistic regression of P against U, classes of equal weight; the last one is the constant."""
    x, y = np.vstack([p, u]), np.r_[np.ones(len(p)), np.zeros(len(u))]
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, 0.5 / len(p), 0.5 / len(u))
    for _ in range(steps):
        w -= 0.5 * (x.T @ (weight * (_sigmoid(x @ w) - y)) + 1e-3 * w)
    return w


def _prior(p: np.ndarray, w: np.ndarray) -> float:
    ratio = np.exp(np.clip(np.c_[p, np.ones(len(p))] @ w, -30, 30))
    return float(np.clip(1 / np.median(ratio), 0.05, 0.99))


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The share of positives in U, from standardised P and U alone."""
    return _prior(p, _ratio_weights(p, u))


def fit(p: np.ndarray, u: np.ndarray, prior: float | None = None, seed: int = SEED, moments: tuple | None = None) -> Model:
    """Fit on feature matrices of positives and unlabelled texts; the same input gives the same model.

    ``moments`` are means and deviations to standardise by, those of ``u`` by default.
    """
    p, u = p[np.lexsort(p.T)].astype(np.float64), u[np.lexsort(u.T)].astype(np.float64)
    mean, scale = moments or _moments(u)
    p, u = np.clip((p - mean) / scale, -8, 8), np.clip((u - mean) / scale, -8, 8)
    prior = estimate_prior(p, u) if prior is None else float(np.clip(prior, 0.01, 0.99))
    rng = np.random.default_rng(seed)
    d = p.shape[1]
    theta = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.25, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for step in range(1, STEPS + 1):
        a, b = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        ha, hb = np.tanh(a @ theta[0] + theta[1]), np.tanh(b @ theta[0] + theta[1])
        ga, gb = ha @ theta[2] + theta[3], hb @ theta[2] + theta[3]
        negative = np.logaddexp(0, gb).mean() - prior * np.logaddexp(0, ga).mean()
        da, db = -prior * (1 - _sigmoid(ga)) / len(a), np.zeros(len(b))
        turn = 1.0 if negative >= 0 else -1.0
        if turn < 0:
            da = np.zeros(len(a))
        da = da - turn * prior * _sigmoid(ga) / len(a)
        db = db + turn * _sigmoid(gb) / len(b)
        la, lb = np.outer(da, theta[2]) * (1 - ha**2), np.outer(db, theta[2]) * (1 - hb**2)
        grads = [a.T @ la + b.T @ lb + 1e-4 * theta[0], la.sum(0) + lb.sum(0), ha.T @ da + hb.T @ db + 1e-4 * theta[2], np.array([da.sum() + db.sum()])]
        rate = 0.01 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for t, g, mm, vv in zip(theta, grads, m, v, strict=True):
            mm += 0.1 * (g - mm)
            vv += 0.001 * (g * g - vv)
            t -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, theta[0], theta[1], theta[2], float(theta[3][0]), prior)


def held_out(doc_id: Column) -> Column:
    """Whether a row's label must not be learned from: crc32 of the id's text, mod 4, is 2. Null ids: true."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def _figures(texts: DataFrame) -> DataFrame:
    """(doc_id, h, x): id, a hash of id and text, and features of every row."""

    @F.pandas_udf("array<float>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([features(x) for x in texts], dtype=object)

    return texts.select("doc_id", F.xxhash64("doc_id", "text", F.lit(3)).alias("h"), of("text").alias("x"))


def _sample(figures: DataFrame, at_most: int) -> np.ndarray:
    """Features of about ``at_most`` different rows, chosen by their hash; repeated rows count once."""
    n = figures.select(F.count(F.lit(1))).first()[0]
    if n > at_most:
        figures = figures.where(F.pmod("h", F.lit(1_000_000)) < int(1_000_000 * at_most / n))
    got = figures.dropDuplicates(["h"]).select("x").toPandas()
    return np.stack(got["x"].to_numpy()) if len(got) else np.zeros((0, N_FEATURES), np.float32)


def _all_moments(figures: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each feature over all rows, in single precision, so that no order of summing shows."""
    at = [F.get("x", F.lit(i)).cast("double") for i in range(N_FEATURES)]
    got = np.array(figures.select(*map(F.avg, at), *map(F.stddev_pop, at)).first(), dtype=np.float32).astype(np.float64)
    mean, scale = got[:N_FEATURES], got[N_FEATURES:]
    return mean, np.where(scale < 1e-6, 1.0, scale)


def _sums(figures: DataFrame, basis, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Means over all rows of log(1 + exp(g)), its gradient and its Hessian in ``w``, for g = basis(x) @ w."""
    d = len(w)

    def run(batches):
        total = np.zeros(2 + d + d * d)
        for pdf in batches:
            if len(pdf):
                z = basis(np.stack(pdf["x"].to_numpy()).astype(np.float64))
                g = z @ w
                s = _sigmoid(g)
                total += np.r_[len(z), np.logaddexp(0, g).sum(), s @ z, ((z * (s * (1 - s))[:, None]).T @ z).ravel()]
        yield pd.DataFrame({"cell": np.arange(len(total), dtype=np.int32), "v": total})

    rows = figures.select("x").mapInPandas(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    got = np.zeros(2 + d + d * d)
    for r in rows:
        got[r.cell] = r.v
    got[1:] /= max(1.0, got[0])
    return got[1], got[2 : 2 + d], got[2 + d :].reshape(d, d)


def _newton(figures: DataFrame, basis, w: np.ndarray, share: float, positives, ridge: float) -> np.ndarray:
    """The ``w`` that minimises ``share`` times the mean over all rows of log(1 + exp(g)) plus what ``positives`` adds.

    ``positives(w, mean)`` gives value, gradient and Hessian of the part of P, and whether ``w`` may be
    taken, given that mean. A step that raises the sum or may not be taken is halved. Returns ``w`` and whether
    it has converged within ``PASSES`` passes.
    """
    best, step, done = None, np.zeros_like(w), False
    for _ in range(PASSES):
        mean, gradient, hessian = _sums(figures, basis, w + step)
        value, g, h, allowed = positives(w + step, mean)
        value += share * mean + ridge / 2 * float((w + step) @ (w + step))
        if best is None and not allowed:
            return w, True  # the start already lies on the bound
        if best is not None and (not allowed or value > best):
            step = step / 2
            if np.abs(step).max() < 1e-9:
                done = True
                break
            continue
        w, done = w + step, best is not None and best - value < 1e-7
        best = value
        if done:
            break
        step = -np.linalg.solve(share * hessian + h + ridge * np.eye(len(w)), share * gradient + g + ridge * w)
    return np.round(w, 9), done


def _unpack(theta: np.ndarray, d: int = N_FEATURES) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    cut = d * HIDDEN
    return theta[:cut].reshape(d, HIDDEN), theta[cut : cut + HIDDEN], theta[cut + HIDDEN : -1], float(theta[-1])


def _outputs(z: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden layer and g of every row; a row's values do not depend on the rows beside it."""
    w1, b1, w2, b2 = _unpack(theta)
    h = np.tanh(np.einsum("nd,dh->nh", z, w1) + b1)
    return h, np.einsum("nh,h->n", h, w2) + b2


def _gradients(z: np.ndarray, h: np.ndarray, by: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """The gradient of every row's loss in ``theta``, given its derivative by g."""
    inner = (by[:, None] * _unpack(theta)[2]) * (1 - h**2)
    return np.c_[(z[:, :, None] * inner[:, None, :]).reshape(len(z), -1), inner, by[:, None] * h, by]


_UNIT = 2.0**30


def _network_sums(figures: DataFrame, plain, theta: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean over all rows of log(1 + exp(g)) and its gradient in ``theta``, from sums of whole numbers."""

    def run(batches):
        total = np.zeros(2 + len(theta), dtype=np.int64)
        for pdf in batches:
            for k in range(0, len(pdf), 2048):
                z = plain(np.stack(pdf["x"].to_numpy()[k : k + 2048]).astype(np.float64))[:, :-1]
                h, g = _outputs(z, theta)
                parts = np.c_[np.logaddexp(0, g), _gradients(z, h, _sigmoid(g), theta)]
                total += np.r_[len(z), np.rint(parts * _UNIT).astype(np.int64).sum(0)]
        yield pd.DataFrame({"cell": np.arange(len(total), dtype=np.int32), "v": total})

    summed = figures.select("x").mapInPandas(run, "cell int, v long").groupBy("cell").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    got = np.zeros(2 + len(theta))
    for r in summed.collect():  # a row a weight
        got[r.cell] = float(r.v)
    got[1:] /= _UNIT * max(1.0, got[0])
    return got[1], got[2:]


def _descend(objective, theta: np.ndarray, memory: int = 10) -> tuple[np.ndarray, int, bool]:
    """L-BFGS with halved steps: the point reached, the passes used and whether it has converged.

    ``objective(theta)`` gives value, gradient and whether the point may be taken.
    """
    value, gradient, allowed = objective(theta)
    passes, pairs = 1, []
    if not allowed:
        return theta, passes, True
    while passes < DESCENT:
        q, used = gradient.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            used.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, y), a in zip(pairs, reversed(used), strict=True):
            q += s * (a - (y @ q) / (s @ y))
        slope, size, moved = -(gradient @ q), 1.0, False
        while passes < DESCENT and size > 1e-4:
            new_value, new_gradient, allowed = objective(theta - size * q)
            passes += 1
            if allowed and new_value <= value + 1e-4 * size * slope:
                moved = True
                break
            size /= 2
        if not moved:
            return theta, passes, size <= 1e-4
        step, change, gain = -size * q, new_gradient - gradient, value - new_value
        if step @ change > 1e-12:
            pairs = [*pairs, (step, change)][-memory:]
        theta, value, gradient = theta + step, new_value, new_gradient
        if gain < TOLERANCE * max(1.0, abs(value)):
            return theta, passes, True
    return theta, passes, False


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_fit: int = MAX_FIT) -> Model:
    """Fit on texts labelled 1 and on all texts without regard to labels, of rows that are not held out.

    Labels other than 0 and 1 and rows without id or text are left out; an id
    labelled both ways is no positive. Repeated rows of U count as often as they stand.
    Without any usable positive the model is the prior alone and scores every text alike.
    A step of the descent that would turn the risk's second part negative is not taken.
    """
    known = (
        labels.select("doc_id", F.col(label).alias("y"))
        .where(F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
    )
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "quality")
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    figures = scratch.save(_figures(texts), "figures")
    p = _sample(figures.join(known.where("y = 1").select("doc_id"), "doc_id", "left_semi"), max_fit).astype(np.float64)
    if not len(p):
        scratch.drop("figures")
        flat = np.zeros(N_FEATURES)
        return Model(flat, flat + 1, np.zeros((N_FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 0.5)
    p = p[np.lexsort(p.T)]
    mean, scale = moments = _all_moments(figures)

    def plain(x):
        return np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))]

    z = plain(p)

    def ratio(w, _):
        s = _sigmoid(-(z @ w))
        return 0.5 * np.logaddexp(0, -(z @ w)).mean(), -0.5 * (s @ z) / len(z), 0.5 * (z * (s * (1 - s))[:, None]).T @ z / len(z), True

    u = _sample(figures, max_fit).astype(np.float64)
    u = u[np.lexsort(u.T)]
    start = _ratio_weights(z[:, :-1], plain(u)[:, :-1])
    weights, sure = _newton(figures, plain, start, 0.5, ratio, 1e-3)
    prior = round(_prior(z[:, :-1], weights), 6)
    first = fit(p, u, prior, moments=moments)
    known_z = z[:, :-1]

    def both_layers(theta):
        mean, gradient = _network_sums(figures, plain, theta)
        h, g = _outputs(known_z, theta)
        pull = _gradients(known_z, h, np.full(len(g), 1 / len(g)), theta).sum(0)
        value = mean - prior * g.mean() + 0.5e-4 * float(theta @ theta)
        return value, gradient - prior * pull + 1e-4 * theta, mean >= prior * np.logaddexp(0, g).mean()

    theta, passes, settled = _descend(both_layers, np.r_[first.w1.ravel(), first.b1, first.w2, first.b2])
    theta = np.round(theta, 9)
    w1, b1, w2, b2 = _unpack(theta)

    scratch.drop("figures")
    model = Model(mean, scale, w1, b1, w2, b2, prior, passes, sure and settled)
    if not model.converged:
        warnings.warn(f"the classifier has not converged: prior {sure}, layers {settled} after {passes} passes", stacklevel=2)
    return model


def score(text: Column, model: Model) -> Column:
    """Chance (0 to 1) that the text's label is 1; null and empty texts are scored too."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(_matrix(texts)), dtype="float64")

    return run(text)


def classify(docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Every row and column of ``docs`` plus ``score`` and ``predicted``.

    Null and empty texts get the score of a text without any sign of form. Rows are
    scored one by one, repeated ones alike. Columns of the added names are
    replaced. An empty table gives an empty table.
    """
    bound_batches(docs.sparkSession)
    scored = docs.withColumn("score", score(F.col(text), model))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs, model).where("predicted = 1").select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
