"""Language identification by hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of +1 and -1,
drawn from its code point.  A trigram binds three of them: the first permuted
twice, the second once, the third not at all, multiplied element by element.  A
text bundles (adds) the vectors of its trigrams, a language bundles the vectors
of its texts, and a text takes the language whose prototype has the largest
cosine with it.

Texts are lower-cased; whatever is no letter counts as a gap, and neighbouring
gaps as one.  A null text, or one without a letter, gets ``und`` and score 0;
so does every text when there is nothing to learn from.  A tie goes to the
smaller language name.  The score is the cosine, at least 0.  Repeated rows are
judged one by one; columns ``lang_pred`` and ``score`` of the input are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brinkcast.llm.arrow import begin, chunks, with_columns_schema

UNKNOWN = "und"
#: Characters that are held as arrays at a time, trigrams that are bound at a time.
CHARS, TRIGRAMS = 400_000, 4096
#: Texts in one matrix of counts.
TEXTS = 500


@dataclass(frozen=True)
class Profiles:
    """Prototypes, one row for each language, and the seed of the letters."""

    langs: tuple[str, ...]
    vectors: np.ndarray
    seed: int


class Encoder:
    """Texts to bundled trigram vectors, within one task."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed = dims, seed
        self.letters: dict[int, np.ndarray] = {}
        self.is_letter = np.zeros(0x110000, bool)
        self.is_letter[[i for i in range(0x110000) if chr(i).isalpha()]] = True

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            rng = np.random.Generator(np.random.PCG64([self.seed, point]))
            self.letters[point] = (2 * rng.integers(0, 2, self.dims, dtype=np.int8) - 1).astype(np.int8)
        return self.letters[point]

    def symbols(self, text: str) -> np.ndarray:
        """Code points of letters, 0 for everything else."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        points[~self.is_letter[points]] = 0
        return points

    def bundles(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One vector for each text, and which texts have a letter."""
        out = np.zeros((len(texts), self.dims), np.float64)
        seen = np.zeros(len(texts), bool)
        pending: list[tuple[int, np.ndarray]] = []
        held = 0
        for i, text in enumerate(texts):
            piece = np.zeros(1, np.int64)  # a gap stands at either end
            for at in range(0, max(1, len(text)), CHARS):  # two symbols go over to the next piece
                parts = [piece[-2:], self.symbols(text[at : at + CHARS])]
                if at + CHARS >= len(text):
                    parts.append(np.zeros(1, np.int64))
                piece = np.concatenate(parts)
                piece = piece[np.concatenate(([True], (piece[1:] != 0) | (piece[:-1] != 0)))]
                seen[i] |= bool(piece.any())
                pending.append((i, piece))
                held += len(piece)
                if held >= CHARS:
                    self._add(pending, out)
                    pending, held = [], 0
        self._add(pending, out)
        return out, seen

    def _add(self, pieces: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
        pieces = [(i, p) for i, p in pieces if len(p) >= 3]
        if not pieces:
            return
        rows, row_of = np.unique([i for i, _ in pieces], return_inverse=True)
        sizes = np.array([len(p) for _, p in pieces])
        points = np.concatenate([p for _, p in pieces])
        alphabet = np.flatnonzero(np.bincount(points, minlength=1))
        index = np.zeros(int(points.max()) + 1, np.int64)
        index[alphabet] = np.arange(len(alphabet))
        s = index[points]
        n = len(alphabet)
        codes = (s[:-2] * n + s[1:-1]) * n + s[2:]
        ends = np.cumsum(sizes)
        whole = np.ones(len(codes) + 2, bool)  # not across the border of two pieces
        whole[ends - 1] = whole[ends - 2] = False
        whole = whole[: len(codes)]
        codes, owner = codes[whole], np.repeat(row_of, sizes)[: len(codes)][whole]
        if n**3 <= 8_000_000:
            used = np.flatnonzero(np.bincount(codes, minlength=n**3))
            place = np.zeros(n**3, np.int32)
            place[used] = np.arange(len(used))
            column = place[codes]
        else:
            used, column = np.unique(codes, return_inverse=True)
        letters = np.stack([self.letter(int(p)) for p in alphabet])
        once, twice = np.roll(letters, 1, axis=1), np.roll(letters, 2, axis=1)
        order = np.argsort(column, kind="stable") if len(used) > TRIGRAMS else None
        for lo in range(0, len(used), TRIGRAMS):
            part = used[lo : lo + TRIGRAMS]
            if order is None:
                c, o = column, owner
            else:
                at = np.searchsorted(column[order], [lo, lo + len(part)])
                pick = order[at[0] : at[1]]
                c, o = column[pick] - lo, owner[pick]
            bound = twice[part // (n * n)] * once[part // n % n] * letters[part % n]
            bound = bound.astype(np.float32)
            for r in range(0, len(rows), TEXTS):
                mine = (o >= r) & (o < r + TEXTS)
                m = min(TEXTS, len(rows) - r)
                counts = np.bincount((o[mine] - r) * len(part) + c[mine], minlength=m * len(part)).astype(np.float32)
                out[rows[r : r + m]] += counts.reshape(m, len(part)) @ bound


def learn_profiles(
    docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = 1024, seed: int = 7
) -> Profiles:
    """Prototypes of the languages that ``docs`` names; rows without text or
    language teach nothing.

    Tasks bundle their texts per language, the sums are added by Spark.  To the
    driver comes one vector for each language.
    """

    def bundle(batches):
        begin("language_id")
        encoder = Encoder(dims, seed)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in chunks(batch, [len(t) for t in texts], CHARS):
                vectors, _ = encoder.bundles(texts[lo:hi])
                for name in set(langs[lo:hi]):
                    mine = [i for i, x in enumerate(langs[lo:hi]) if x == name]
                    sums[name] = sums.get(name, 0) + vectors[mine].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"]
            )

    rows = (
        docs.select(F.col(text).alias("t"), F.col(lang).alias("l"))
        .where("t is not null and l is not null")
        .mapInArrow(bundle, "lang string, v array<double>")
        .select("lang", F.posexplode("v").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
        .orderBy("lang")
        .collect()
    )
    vectors = np.array([[c.x for c in r.v] for r in rows], np.float64).reshape(len(rows), dims)
    return Profiles(tuple(r.lang for r in rows), vectors, seed)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    kept, schema = with_columns_schema(docs, {"lang_pred": T.StringType(), "score": T.DoubleType()})
    at = kept.columns.index(text)
    norms = np.linalg.norm(profiles.vectors, axis=1)
    unit = profiles.vectors / np.where(norms == 0, 1, norms)[:, None]
    names, seed, dims = profiles.langs, profiles.seed, profiles.vectors.shape[1]

    def judge(batches):
        begin("language_id")
        encoder = Encoder(dims, seed)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            guesses, scores = [], []
            for lo, hi in chunks(batch, [len(t) for t in texts], CHARS):
                vectors, seen = encoder.bundles(texts[lo:hi])
                if not names:
                    seen[:] = False
                length = np.linalg.norm(vectors, axis=1)
                cosine = vectors @ unit.T / np.where(length == 0, 1, length)[:, None] if names else vectors[:, :1]
                best = cosine.round(12).argmax(axis=1)
                top = np.clip(cosine[np.arange(len(best)), best], 0, 1)
                guesses += [names[b] if s else UNKNOWN for b, s in zip(best, seen)]
                scores.append(np.where(seen, top, 0.0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(guesses, pa.string()), pa.array(np.concatenate(scores or [[]]), pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return kept.mapInArrow(judge, schema)


def score_limits(judged: DataFrame, lang: str = "lang", low: float = 0.01, share: float = 0.5) -> dict[str, float]:
    """Least score of a text of each language: ``share`` of the ``low`` quantile of the
    scores of texts that are labelled with it and recognised.  One number a language."""
    right = judged.where(F.col(lang) == F.col("lang_pred"))
    found = right.groupBy("lang_pred").agg(F.percentile_approx("score", low, 10_000).alias("q")).collect()
    return {r.lang_pred: share * r.q for r in found}


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
