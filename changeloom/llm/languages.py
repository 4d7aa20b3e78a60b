"""Language identification as a mixture: which languages a text is made of, and in what shares.

Every language is a distribution over hashed byte trigrams of lower-cased text, counted over all
documents it may learn from. A text is explained as a mixture of them: expectation-maximisation finds
the shares, and a language joins the set only if the likelihood it adds is worth its penalty. The
log-likelihood is concave in the shares, so the slope at the present mixture bounds what a language
could add; most are ruled out by that without a single iteration.

The model has languages x ``BINS`` numbers whatever the corpus; ``most_languages`` bounds it and too
many raise an error. It goes to the tasks with the function.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and no shares, as is
every text if no row names a language; ties go to the language first in order; repeated rows give
repeated results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import bounded, documents, narrow, raw, remainder

BINS = 1 << 15
ROUNDS = 25
#: trigrams overlap, so three of them are about one piece of evidence
EVIDENCE = 1 / 3


def trigram_bins(text: bytes) -> np.ndarray:
    data = np.frombuffer(b" " + text.decode().lower().encode() + b" ", np.uint8).astype(np.uint32)
    pairs = (data[:-1] << np.uint32(8)) | data[1:]
    code = (pairs[:-1] << np.uint32(8)) | data[2:]
    code *= np.uint32(2654435761)
    code >>= np.uint32(17)
    return code


def trigram_counts(docs: DataFrame) -> DataFrame:
    """lang, bin, n over all documents given; rows without a language teach nothing."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        for batch in bounded(batches):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), raw(batch.column("text")), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():  # counted in one go, a line break between two texts
                counts[lang] = counts.get(lang, 0) + np.bincount(trigram_bins(b"\n".join(own)), minlength=BINS)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            columns = [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bin", "n"])

    known = narrow(docs, F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    parts = known.mapInArrow(run, "lang string, bin int, n long")
    return parts.groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, most_languages: int = 256) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their smoothed trigram distributions as rows."""
    table = trigram_counts(docs).toArrow()
    codes = table.column("lang").combine_chunks().dictionary_encode() if table.num_rows else None
    if codes is None:
        return [], np.zeros((0, BINS), np.float32)
    langs = codes.dictionary.to_pylist()
    if len(langs) > most_languages:
        raise ValueError(f"{len(langs)} languages; at most {most_languages} are allowed")
    counts = np.zeros((len(langs), BINS))
    counts[codes.indices.to_numpy(), table.column("bin").to_numpy()] = table.column("n").to_numpy()
    order = np.argsort(langs)
    smooth = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BINS)
    return [langs[i] for i in order], smooth[order]


def shares(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Expectation-maximisation from equal shares: the shares, and the log-likelihood."""
    mix, total = np.full(len(p), 1 / len(p)), n.sum()
    for _ in range(ROUNDS):
        ratio = n / (mix @ p)
        step = mix * (p @ ratio) / total
        if np.abs(step - mix).max() < 1e-4:
            break
        mix = step
    return mix, float(n @ np.log(mix @ p))


def mixture(p: np.ndarray, n: np.ndarray, penalty: float = 2.0) -> dict[int, float]:
    """Language rows and their shares; ``penalty`` is in units of log(evidence) per language."""
    evidence = n * EVIDENCE
    cost = penalty * np.log(max(2.0, evidence.sum()))
    chosen = [int(np.argmax(np.log(p) @ evidence))]
    mix, best = np.ones(1), float(np.log(p[chosen[0]]) @ evidence)
    while len(chosen) < len(p):
        slope = p @ (evidence / (mix @ p[chosen])) - evidence.sum()
        slope[chosen] = 0
        tried = [
            (found[1], i, found[0])
            for i in np.flatnonzero(slope > cost)
            for found in [shares(p[[*chosen, i]], evidence)]
        ]
        if not tried or max(t[0] for t in tried) - best <= cost:
            break
        best, i, mix = max(tried, key=lambda t: (t[0], -t[1]))
        chosen.append(int(i))
    return dict(zip(chosen, mix.tolist(), strict=True))


def identify(docs: DataFrame, langs: list[str], p: np.ndarray, *extra: Column) -> DataFrame:
    """doc_id, lang_pred, score and the whole mixture as two arrays."""

    def run(batches):
        for batch in bounded(batches):
            mixes = []
            for text in raw(batch.column("text")):
                found = {}
                if langs and any(map(str.isalpha, text.decode())):
                    n = np.bincount(trigram_bins(text), minlength=BINS)
                    at = np.flatnonzero(n)
                    found = mixture(p[:, at], n[at])
                mixes.append(sorted(found.items(), key=lambda m: (-m[1], m[0])))
            columns = [
                pa.array([langs[m[0][0]] if m else "und" for m in mixes], pa.string()),
                pa.array([min(1.0, m[0][1]) if m else 0.0 for m in mixes], pa.float64()),
                pa.array([[langs[i] for i, _ in m] for m in mixes], pa.list_(pa.string())),
                pa.array([[s for _, s in m] for m in mixes], pa.list_(pa.float64())),
            ]
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"] + ["lang_pred", "score", "langs", "shares"]
            yield pa.RecordBatch.from_arrays([*rest, *columns], names)

    wanted = narrow(docs, *extra)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in wanted.drop("text").schema]
    fields += ["lang_pred string", "score double", "langs array<string>", "shares array<double>"]
    return wanted.mapInArrow(run, ", ".join(fields))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = (remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    langs, p = fit(docs.where(~held_out))
    found = identify(docs, langs, p, held_out)
    return found.select("doc_id", "held_out", "lang_pred", "score", "langs", "shares")
