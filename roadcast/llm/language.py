"""Language ID with a string kernel: presence of runs of 1 to 3 characters, Nyström landmarks, ridge regression per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadcast.llm.common import Steps

CELL_BITS = 18
CELLS = 1 << CELL_BITS  # runs of characters share this many cells by hash, whatever the script
_MIX = [np.uint32(m) for m in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F)]
UNDETERMINED = "und"


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _cell(code: np.ndarray) -> np.ndarray:
    code = (code ^ (code >> np.uint32(15))) * _MIX[1]
    code = (code ^ (code >> np.uint32(13))) * _MIX[2]
    return code >> np.uint32(32 - CELL_BITS)


def present_runs(text: str, seen: np.ndarray) -> np.ndarray:
    """Cells of the runs of 1, 2 and 3 characters that the whole text has; ``seen`` is scratch space and comes back empty.

    Characters are code points, lower-cased; white space of any kind and length is one blank.
    """
    code = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "surrogatepass"), np.uint32) * _MIX[0]
    seen[_cell(code)] = True
    if len(code) > 1:
        pair = code[:-1] * _MIX[3] + code[1:] + np.uint32(1)
        seen[_cell(pair)] = True
        if len(code) > 2:
            seen[_cell(pair[:-1] * _MIX[3] + code[2:] + np.uint32(2))] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found.astype(np.int32)


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # presence cells x languages: kernel columns, landmark projection and ridge weights in one


def fit_model(samples: list[tuple[str, np.ndarray]], landmarks: int = 240, ridge: float = 1e-2) -> Model:
    """Kernel ridge regression, one language against the rest, on Nyström features of the presence kernel.

    k(x, y) is the number of runs that both texts have over the root of the product of their numbers.  The landmarks are taken evenly from the
    languages.  Both maps after the presence vector are linear, so they are kept as one matrix.
    """
    languages = sorted({lang for lang, _ in samples})
    by_lang = {lang: [r for l, r in samples if l == lang] for lang in languages}
    share = -(-landmarks // len(languages)) if languages else 0
    chosen = [r for lang in languages for r in by_lang[lang][:share]]
    used = np.unique(np.concatenate(chosen)) if chosen else np.zeros(0, np.int32)
    place = np.full(CELLS, -1, np.int32)
    place[used] = np.arange(len(used))

    def rows(runs: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(runs), len(used)), np.float32)
        for n, r in enumerate(runs):
            at = place[r]
            out[n, at[at >= 0]] = 1 / np.sqrt(max(1, len(r)))
        return out

    marks = rows(chosen)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    good = values > 1e-6 * max(values.max(initial=0.0), 1e-12)
    project = marks.T @ (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)
    runs, labels = [r for _, r in samples], np.array([languages.index(lang) for lang, _ in samples])
    features = np.concatenate([rows(runs[n : n + 256]) @ project for n in range(0, len(runs), 256)]) if runs else np.zeros((0, project.shape[1]))
    features = features.astype(np.float64)
    goal = np.where(labels[:, None] == np.arange(len(languages)), 1.0, 0.0)
    weight = 1 / np.bincount(labels, minlength=len(languages))[labels] if len(labels) else np.zeros(0)
    weighed = features * weight[:, None]
    solved = np.linalg.solve(weighed.T @ features + ridge * np.eye(features.shape[1]) * weight.sum() / max(1, len(runs)), weighed.T @ goal)
    weights = np.zeros((CELLS, len(languages)), np.float32)
    weights[used] = project @ solved.astype(np.float32)
    return Model(languages, weights)


def scores_of(runs: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Decision values of a batch: its presence matrix, in compressed rows, times the weights."""
    sizes = np.array([len(r) for r in runs])
    out = np.zeros((len(runs), weights.shape[1]), np.float32)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.cumsum(np.r_[0, sizes[full][:-1]])
        out[full] = np.add.reduceat(weights[np.concatenate([runs[n] for n in full])], starts, axis=0) / np.sqrt(sizes[full])[:, None]
    return out


def _runs(batches):
    seen = np.zeros(CELLS, bool)
    for batch in batches:
        found = [present_runs(t.as_py(), seen) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in found], pa.binary())], names=["lang", "runs"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 500, landmarks: int = 240, ridge: float = 1e-2) -> Model | None:
    """Fit on labelled documents that are not held out; None when there are none.

    About ``per_language`` documents of each language are drawn by a digest of the id and the text; this bounds the fit, the rest is predicted only.  The driver
    gathers presence vectors of the sample.  Number of languages x ``per_language`` vectors meet there; a vector is no larger than its text.
    """
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length(F.trim("text")) > 0) & ~held_out(F.col("doc_id")))
    steps = Steps(docs.sparkSession)
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    rate = F.lit(float(per_language)) / F.col("_n")
    coin = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = steps.write(labelled.join(F.broadcast(counts), "lang").filter(coin < rate).select("lang", "text"))
    rows = sample.mapInArrow(_runs, "lang string, runs binary").orderBy("lang", F.xxhash64("runs")).collect()
    if not rows:
        return None
    return fit_model([(r[0], np.frombuffer(r[1], np.int32)) for r in rows], landmarks, ridge)


def _predict(shared):
    def run(batches) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        seen = np.zeros(CELLS, bool)
        for batch in batches:
            texts = [t.as_py() for t in batch.column("_lang_text")]
            known = [n for n, t in enumerate(texts) if model and t and _has_letter(t)]
            lang, score = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            for at in range(0, len(known), 64):
                some = known[at : at + 64]
                values = scores_of([present_runs(texts[n], seen) for n in some], model.weights).astype(np.float64)
                best = values.argmax(axis=1)
                shares = np.exp(8 * (values - values.max(axis=1, keepdims=True)))
                sure = 1 / shares.sum(axis=1)
                for n, b, s in zip(some, best.tolist(), sure.tolist()):
                    lang[n], score[n] = model.languages[b], s
            rest = [c for c in batch.schema.names if c != "_lang_text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*rest, "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1: the share of the best language's value).

    Null texts, texts without a letter, and every text when nothing could be learned are ``und`` with score 0.  Repeated rows each get
    their result, equal texts the same; an empty table gives no rows; a null id is never held out; other columns are not read.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("_lang_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def reject(docs: DataFrame, model: Model | None, least_score: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those of undetermined language or a score below ``least_score``; rows and columns as they are, whatever their names.

    Null texts and texts without a letter go; every row of an empty table or without a model goes; repeated rows share their fate.
    """
    carried = [F.col(c).alias(f"_c{n}") for n, c in enumerate(docs.columns)]
    rows = docs.select(*carried, F.col(text_col).alias("_lang_text"))
    kinds = ", ".join(f"_c{n} {f.dataType.simpleString()}" for n, f in enumerate(docs.schema))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    judged = rows.mapInArrow(_predict(shared), f"{kinds}, lang_pred string, score double")
    kept = judged.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
    return kept.select(*[F.col(f"_c{n}").alias(c) for n, c in enumerate(docs.columns)])
