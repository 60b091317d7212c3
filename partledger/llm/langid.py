"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. A letter triple is bound by
multiplying the first letter's vector rotated by two, the second's rotated by one, and the third's;
the triples of a text are bundled by adding them up. Bundles of labelled texts add up to a language's
prototype, and a text gets the language whose prototype has the highest cosine with its bundle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
SEED = 7
TRAIN_ROWS = 4000       # labelled rows of a language that its prototype is bundled from, about
SLICE_CHARS = 1 << 20   # characters worked on at once; longer texts are summed slice by slice
DENSE = 1 << 20         # triples of so small an alphabet are counted in a plain array


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: the lower-case letter's code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


@lru_cache(maxsize=4096)
def letter_vector(point: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    bits = np.random.Generator(np.random.Philox(key=[SEED, point])).integers(0, 2, dimensions)
    return (2 * bits - 1).astype(np.int8)


def _points(text: str) -> np.ndarray:
    """A text as letters with single gaps (0) around and between words."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate([[0], _letters()[raw], [0]]).astype(np.uint32)
    return points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])]


def _add(bundles: np.ndarray, points: np.ndarray, rows: np.ndarray) -> None:
    """Add the triples of a run of letters to the rows that they belong to."""
    alphabet, code = np.unique(points, return_inverse=True)
    k, code = len(alphabet), code.astype(np.int64)
    triple = (code[:-2] * k + code[1:-1]) * k + code[2:]
    inside = (rows[:-2] == rows[2:]) & (points[1:-1] != 0)  # a gap is no middle of a triple
    triple, row = triple[inside], rows[:-2][inside]
    if not len(triple):
        return
    if k ** 3 <= DENSE:
        used = np.flatnonzero(np.bincount(triple, minlength=k ** 3))
        place = np.zeros(k ** 3, np.int64)
        place[used] = np.arange(len(used))
        which = place[triple]
    else:
        used, which = np.unique(triple, return_inverse=True)
    d = bundles.shape[1]
    vectors = np.stack([letter_vector(int(p), d) for p in alphabet])
    bound = (np.roll(vectors, 2, axis=1)[used // (k * k)] * np.roll(vectors, 1, axis=1)[used // k % k] * vectors[used % k])
    first, own = np.unique(row, return_inverse=True)
    counts = np.bincount(own * len(used) + which, minlength=len(first) * len(used)).reshape(len(first), len(used))
    bundles[first] += counts.astype(np.float32) @ bound.astype(np.float32)


def bundle(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """One row per text: the sum of its triples' vectors; zero for a text without letters."""
    out = np.zeros((len(texts), dimensions), np.float32)
    held, rows, size = [], [], 0

    def flush() -> None:
        nonlocal held, rows, size
        if held:
            _add(out, np.concatenate(held), np.repeat(rows, [len(h) for h in held]))
        held, rows, size = [], [], 0

    for i, text in enumerate(texts):
        points = _points(text)
        for a in range(0, max(1, len(points) - 2), SLICE_CHARS):
            part = points[a:a + SLICE_CHARS + 2]  # slices overlap by two, so each triple counts once
            if rows and rows[-1] == i or size + len(part) > SLICE_CHARS:
                flush()
            held.append(part)
            rows.append(i)
            size += len(part)
    flush()
    return out


def _unit(a: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(a, axis=-1, keepdims=True)
    return np.divide(a, norm, out=np.zeros_like(a), where=norm > 0)


def prototypes(labelled: DataFrame, text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS,
               dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and a unit vector for each, from rows with a text and a language.

    A language with more than ``train_rows`` rows gives about that many, chosen by a hash of the text,
    the same ones in every run. Texts count alike, whatever their length. What comes to the driver is
    one vector per language.
    """
    rows = labelled.select(F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null")
    share = rows.groupBy("l").agg(F.count(F.lit(1)).alias("n"))
    # One row per language, like the prototypes: broadcast, so that no text is moved to its language's task.
    picked = rows.join(F.broadcast(share), "l").where(
        F.pmod(F.xxhash64("t"), F.lit(1 << 20)) * F.col("n") < F.lit(float(train_rows) * (1 << 20))).select("l", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            unit = _unit(bundle(batch.column(1).to_pylist(), dimensions)).astype(np.float64)
            for name, vector in zip(batch.column(0).to_pylist(), unit):
                sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            yield pa.RecordBatch.from_pydict({"l": [name] * dimensions, "i": np.arange(dimensions, dtype=np.int32), "x": vector})

    # Rounded before they are added up, so that the order of the tasks does not show.
    parts = picked.mapInArrow(run, "l string, i int, x double").groupBy("l", "i").agg(
        F.sum(F.round(F.col("x") * 1e6).cast("decimal(38,0)")).cast("double").alias("x"))
    found = parts.groupBy("l").agg(F.sort_array(F.collect_list(F.struct("i", "x")))["x"].alias("v")).collect()
    found = sorted((r["l"], r["v"]) for r in found)
    vectors = np.array([v for _, v in found], np.float64).reshape(len(found), dimensions)
    return [name for name, _ in found], _unit(vectors).astype(np.float32)


def identify(docs: DataFrame, languages: list[str], vectors: np.ndarray, text: str = "text") -> DataFrame:
    """Every row and column of ``docs`` plus ``lang_pred`` and ``score``, the cosine (0 if negative).

    ``und`` with score 0 is given to a null text, a text without letters, or when no language was
    learned. Ties go to the language that sorts first. Columns of these names are replaced; each row
    is judged alone, from its text only. Scores are rounded to 6 digits.
    """
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")))
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast((languages, vectors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, learned = shared.value
        for batch in batches:
            own = bundle([t or "" for t in batch.column(at).to_pylist()], vectors.shape[1])
            cosine = np.round((_unit(own) @ learned.T).astype(np.float64), 6)
            known = own.any(axis=1) & bool(names)
            best = cosine.argmax(axis=1) if names else np.zeros(len(own), int)
            score = np.clip(cosine.max(axis=1), 0, 1) if names else np.zeros(len(own))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([names[b] if k else "und" for b, k in zip(best, known)], pa.string()),
                 pa.array(np.where(known, score, 0.0))], [*batch.schema.names, "lang_pred", "score"])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{names}, lang_pred string, score double")
