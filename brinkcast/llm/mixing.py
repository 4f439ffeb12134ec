"""Mixing documents to target weights of domains they belong to in part.

A classifier, fitted on a table of labelled documents, gives every document a
posterior over the domains.  Each document then gets a rate, 0 or more, such that
the expected tokens of each domain, ``sum(rate * tokens * posterior)``, come close
to its target in the sense of least squares, with a small pull of all rates
towards 1.

The rates come from projected gradient steps.  At its optimum a document's rate is
its gradient point put back between its bounds, and the gradient holds nothing of the
other documents but the error of each domain's total; so the state of a step is one
number a domain, and a step is one sum over all documents: the totals at the present
rates, and the moments of the documents that are between their bounds, which
precondition the step.  A step that does not lessen the projected gradient is halved.
It ends when no total is off by more than ``enough`` of all tokens, mostly after five
to ten passes, and fails if ``steps`` passes do not suffice.

With ``whole`` set a document led by the first domain that
``targets`` names, with at most a quarter in domains of target 0, has a rate of at
least 1, and one led by a domain of target 0 has rate 0; the others' rates make up
for both.

The classifier is a multinomial logistic regression on hashed words and on shares
of symbols, capitals, digits, distinct words and repeated lines.  It is fitted on
at most ``labelled`` rows, chosen by a hash of their id; everything else covers
all rows.  Words are runs of letters, digits and characters beyond ASCII.  A null or
empty text has no tokens and counts for nothing, but has a
posterior and a rate.  Of labels that contradict each other the worst holds (the
domain later in ``DOMAINS``).  Repeated rows count as often as they occur.  With
labels of one domain only, or none, every document belongs to the first domain
that ``targets`` names.  Columns of the input named ``tokens``, ``posterior`` or ``rate``
are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinkcast.llm.arrow import begin
from brinkcast.llm.hashing import WordHashes
from brinkcast.llm.storage import stored

DOMAINS = ("good", "low", "toxic")
#: Share of the mixture of each domain; the first keeps its tokens.
TARGETS = {"good": 0.95, "low": 0.05, "toxic": 0.0}
SHAPE = ("log_words", "distinct", "symbols", "capitals", "digits", "word_length", "lines_again")
BUCKETS = 1 << 14

_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_SYMBOLS, _CAPITALS, _DIGITS = b"#*$%&|<>!", bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain number) from quality and toxic flags; null flags count as
    good quality and not toxic."""
    number = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    return labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(number).cast("double").alias("label"))


class Featurizer:
    """Texts to the buckets of their words and figures of their shape, within a task."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.hashes = buckets, WordHashes()

    def of(self, text: str | None) -> tuple[int, np.ndarray, list[float]]:
        """Words, distinct buckets, ``SHAPE``."""
        body = (text or "").encode("utf-8", "surrogatepass")
        words = body.translate(_WORDS).split()
        kinds = set(words)
        found = np.unique(self.hashes.of(list(kinds)) % np.uint64(self.buckets)).astype(np.int64)
        size, n = max(len(body), 1), max(len(words), 1)
        share = lambda drop: (len(body) - len(body.translate(None, drop))) / size
        lines = [x for x in body.split(b"\n") if x.strip()]
        again = 1 - len(set(lines)) / max(len(lines), 1)
        return len(words), found, [np.log1p(len(words)), len(kinds) / n, share(_SYMBOLS), share(_CAPITALS), share(_DIGITS), size / n, again]


@dataclass(frozen=True)
class DomainModel:
    """Weights of a linear classifier: per domain one for each bucket, then ``SHAPE``."""

    words: np.ndarray
    shape: np.ndarray
    intercept: np.ndarray

    def posteriors(self, buckets: list[np.ndarray], shape: np.ndarray) -> np.ndarray:
        score = shape @ self.shape.T + self.intercept
        ends = np.cumsum([0, *map(len, buckets)])
        flat = np.concatenate([np.empty(0, np.int64), *buckets])
        some = np.diff(ends) > 0
        if some.any():
            score[some] += np.add.reduceat(self.words[:, flat].T, ends[:-1][some], axis=0)
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labels: DataFrame, text: str = "text", labelled: int = 20_000, domains=DOMAINS) -> DomainModel | None:
    """Classifier of domains from (doc_id, text) and (doc_id, label); None if the
    labels name less than two domains."""
    n = labels.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, labelled / max(1, n)))
    chosen = labels.where(share).limit(2 * labelled)  # by hash about ``labelled`` rows, never more than twice that
    rows = docs.select("doc_id", F.col(text).alias("_t")).join(F.broadcast(chosen), "doc_id").select("_t", "label")
    size = BUCKETS + len(SHAPE)

    @F.udf(VectorUDT())
    def sparse(buckets, shape):
        at = [*buckets, *range(BUCKETS, size)]
        return Vectors.sparse(size, at, [1.0] * len(buckets) + list(shape))

    def features(batches):
        begin("mixing")
        made = Featurizer()
        for batch in batches:
            _, found, shape = zip(*map(made.of, batch.column(0).to_pylist())) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([f.tolist() for f in found], pa.list_(pa.int64())), pa.array(list(shape), pa.list_(pa.float64())), batch.column(1)],
                ["buckets", "shape", "label"],
            )

    known = stored(rows.mapInArrow(features, "buckets array<long>, shape array<double>, label double"), "labelled")
    figures = known.agg(F.count_distinct("label"), *[f(F.col("shape")[i]) for i in range(len(SHAPE)) for f in (F.avg, F.stddev_pop)]).first()
    if figures[0] < 2:
        return None
    mean = np.array(figures[1::2])
    scale = np.where(np.array(figures[2::2]) > 0, figures[2::2], 1.0)
    plain = F.transform("shape", lambda x, i: (x - F.get(F.lit(mean.tolist()), i)) / F.get(F.lit(scale.tolist()), i))
    fit = LogisticRegression(family="multinomial", regParam=1e-3, standardization=False, maxIter=60).fit(
        known.select(sparse("buckets", plain).alias("features"), "label")
    )
    weights, start = fit.coefficientMatrix.toArray(), np.array(fit.interceptVector)
    shape = weights[:, BUCKETS:] / scale
    found = DomainModel(weights[:, :BUCKETS], shape, start - shape @ mean)
    missing = len(domains) - len(start)  # the model knows labels up to the largest it has seen
    if missing <= 0:
        return found
    never = np.full(missing, -np.inf)
    return DomainModel(*[np.concatenate([a, np.zeros((missing, a.shape[1]))]) for a in (found.words, found.shape)], np.concatenate([found.intercept, never]))


def with_posteriors(docs: DataFrame, model: DomainModel | None, domains=DOMAINS, text: str = "text") -> DataFrame:
    """``docs`` with ``tokens`` (words) and ``posterior`` (one share for each domain)."""
    k = len(domains)

    @F.arrow_udf("struct<tokens: long, posterior: array<double>>")
    def judged(texts: pa.Array) -> pa.Array:
        made = Featurizer()
        tokens, found, shape = zip(*map(made.of, texts.to_pylist())) if len(texts) else ((), (), ())
        if model is None:
            p = np.tile(np.eye(k)[0], (len(texts), 1))
        else:
            p = model.posteriors(list(found), np.array(shape).reshape(len(texts), len(SHAPE)))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * k, pa.int32()), pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), lists], ["tokens", "posterior"])

    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), judged(F.col(f"`{text}`")).alias("made"))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in ("tokens", "posterior")]
    return inner.select(*kept, "made.tokens", "made.posterior")


@dataclass(frozen=True)
class Rates:
    """What a document's rate follows from: the error of each domain's total as a share
    of all tokens, the pull towards 1, and the bounds."""

    errors: tuple[float, ...]
    pull: float
    totals: tuple[float, ...]
    targets: tuple[float, ...]
    whole: int | None = None  # domain whose documents keep a rate of 1 at least
    passes: int = 0

    def _bounds(self, posterior: np.ndarray):
        """Least and largest rate of documents."""
        n = len(posterior)
        if self.whole is None:
            return np.zeros(n), np.full(n, np.inf)
        led = posterior.argmax(axis=1)
        # of equal shares the first domain's leads
        led[posterior[:, self.whole] >= posterior.max(axis=1)] = self.whole
        unwanted = np.array([t == 0 for t in self.targets]) & (np.arange(len(self.targets)) != self.whole)
        sure = (led == self.whole) & (posterior[:, unwanted].sum(axis=1) <= 0.25)
        return np.where(sure, 1.0, 0.0), np.where(unwanted[led], 0.0, np.inf)

    def of(self, posterior: np.ndarray, free: bool = False):
        """Rates of documents, one row of ``posterior`` each; with ``free`` also which
        are between their bounds."""
        least, largest = self._bounds(posterior)
        point = 1 - posterior @ np.array(self.errors) / self.pull
        rate = np.clip(point, least, largest)
        return (rate, (point > least) & (point < largest)) if free else rate

    def sums(self, posterior: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Expected tokens of each domain, then second moments of the posteriors of
        documents between their bounds."""
        rate, free = self.of(posterior, free=True)
        moments = (posterior * (tokens * free)[:, None]).T @ posterior
        return np.concatenate([(tokens * rate) @ posterior, moments.ravel()])


def _totals(rows: DataFrame, k: int, value) -> np.ndarray:
    """Sum over all documents of what ``value(posterior, tokens)`` gives, a vector."""

    def part(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            p = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            v = value(p, batch.column(0).to_numpy(zero_copy_only=False).astype(float))
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["v"])

    sums = rows.select("tokens", "posterior").mapInArrow(part, "v array<double>").select(F.posexplode("v").alias("i", "x"))
    found = {r.i: r.x for r in sums.groupBy("i").agg(F.sum("x").alias("x")).collect()}
    return np.array([found[i] for i in range(len(found))])


def fit_rates(
    rows: DataFrame, targets: dict[str, float], domains=DOMAINS, pull: float = 1e-3, steps: int = 200, enough: float = 1e-9,
    whole: bool = False,
) -> Rates:
    """Rates for a stored table with ``tokens`` and ``posterior``.

    The mixture is scaled so that the first domain of ``targets`` keeps its tokens.
    """
    k = len(domains)
    have = _totals(rows, k, lambda p, t: np.append(t @ p, t.sum()))
    if not len(have) or have[-1] == 0:
        return Rates((0.0,) * k, pull, (0.0,) * k, (0.0,) * k)
    total, have = have[-1], have[:-1] / have[-1]
    weights = np.array([targets.get(d, 0.0) for d in domains], float)
    first = domains.index(next(iter(targets)))
    want = weights / weights[first] * have[first]

    def at(errors: np.ndarray, passes: int) -> tuple[Rates, np.ndarray, np.ndarray]:
        """Rates, by how much the totals' errors differ from those they were made of, moments."""
        fit = Rates(tuple(errors.tolist()), pull, tuple((have * total).tolist()), tuple((want * total).tolist()), first if whole else None, passes)
        found = _totals(rows, k, lambda p, t: fit.sums(p, t)) / total
        return fit, found[:k] - want - errors, found[k:].reshape(k, k)

    fit, gap, moments = at(np.zeros(k), 1)
    while np.abs(gap).max() > enough:
        move = np.linalg.solve(np.eye(k) + moments / pull, gap)
        size = 1.0
        while True:
            if fit.passes >= steps:
                raise ArithmeticError(f"no rates within {steps} passes; totals are off by {np.abs(gap).max():.2g} of all tokens")
            new = at(np.array(fit.errors) + size * move, fit.passes + 1)
            fit = new[0] if np.linalg.norm(new[1]) < np.linalg.norm(gap) else Rates(fit.errors, pull, fit.totals, fit.targets, fit.whole, new[0].passes)
            if new[0] is fit:
                _, gap, moments = new
                break
            size /= 2
    return fit


def with_rates(rows: DataFrame, fit: Rates) -> DataFrame:
    """``rows`` (with ``posterior``) and their ``rate``, what ``fit.of`` gives as column
    expressions: a second Python function in a task is a second worker process, and
    those stay with their memory."""
    share = lambda i: F.get("posterior", F.lit(i))
    point = 1 - sum((share(i) * e for i, e in enumerate(fit.errors)), F.lit(0.0)) / fit.pull
    rate = F.greatest(F.lit(0.0), point)
    if fit.whole is not None:
        most = F.array_max("posterior")
        leads = share(fit.whole) >= most  # of equal shares the first domain's leads
        unwanted = [i for i, t in enumerate(fit.targets) if t == 0 and i != fit.whole]
        sure = leads & (sum((share(i) for i in unwanted), F.lit(0.0)) <= 0.25)
        never = ~leads & (F.array_position("posterior", most) - 1).isin(unwanted)
        rate = F.when(sure, F.greatest(F.lit(1.0), point)).when(never, 0.0).otherwise(rate)
    return rows.withColumn("rate", rate)


def drawn_copies(rate: str = "rate", *by: str):
    """Whole copies for a rate: its whole part, and one more with the chance of the
    rest, by a hash of the columns ``by``.  Expected copies equal the rate, so the
    domains' totals stay near what the rates give."""
    chance = F.pmod(F.xxhash64(F.lit("mix"), *by), F.lit(1 << 20)) / float(1 << 20)
    return (F.floor(rate) + (chance < F.col(rate) - F.floor(rate)).cast("int")).cast("int")
