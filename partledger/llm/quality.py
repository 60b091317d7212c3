"""Quality rules by tokeniser fertility: how a public vocabulary cuts a text tells prose from noise.

Measured on each whole text: characters of words per token, the share of byte-fallback tokens, and the
entropy of its tokens. Each script has a band for the three; a text outside its script's band goes.
Plain counts of words, symbols, repeated lines and repeated five-word windows come before.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partledger.llm.common import Words

MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Accepted values. Few tokens cannot have much entropy: the floor is the lower of ``entropy`` and
    ``entropy_share`` of the most that so many tokens can have. Numbers and codes weigh more in a text
    of fewer than ``SHORT`` tokens, which is held to ``least_short``, if given, instead of ``least_chars``."""

    least_chars: float
    most_chars: float
    most_bytes: float
    entropy: float = 5.5
    entropy_share: float = 0.7
    least_short: float | None = None


SHORT = 100  # tokens
# Parameters: bands by script, for a 32,000-piece vocabulary made mostly from Latin text, which spends more
# tokens on other scripts and bytes on letters that it lacks. Latin is set from the labelled clean documents
# (from 100 tokens on at least 1.65 characters a token, below 1.30; bytes up to 0.077; entropy from 200
# tokens on at least 5.79), its ceiling from real English (4.1). The others are set round one or two passages
# of the Declaration of Human Rights; README has the figures. "toned" is Latin with letters beyond Latin-1;
# "rare" are letters of scripts not listed; "other" is a text without letters.
BANDS: Mapping[str, Band] = {
    "latin": Band(1.6, 6.5, 0.1, 5.65, 0.72, 1.25),
    "toned": Band(0.8, 6.5, 0.25, 5.0, 0.65),
    "greek": Band(0.7, 3.0, 0.2, 3.9, 0.5),
    "cyrillic": Band(1.25, 6.0, 0.15, 5.0, 0.65),
    "hebrew": Band(0.65, 3.0, 0.2, 3.6, 0.5),
    "arabic": Band(0.65, 3.0, 0.25, 3.7, 0.5),
    "devanagari": Band(0.6, 3.0, 0.3, 4.0, 0.5),
    "bengali": Band(0.6, 3.0, 0.35, 4.2, 0.5),
    "gurmukhi": Band(0.28, 3.0, 0.92, 3.2, 0.42),
    "gujarati": Band(0.33, 3.0, 0.88, 3.4, 0.42),
    "odia": Band(0.27, 3.0, 1.0, 3.0, 0.42),
    "tamil": Band(0.65, 3.0, 0.3, 3.9, 0.5),
    "telugu": Band(0.45, 3.0, 0.7, 3.7, 0.5),
    "kannada": Band(0.5, 3.0, 0.55, 4.0, 0.5),
    "malayalam": Band(0.33, 3.0, 0.9, 3.2, 0.38),
    "sinhala": Band(0.42, 3.0, 0.75, 3.7, 0.5),
    "thai": Band(0.75, 4.0, 0.2, 4.3, 0.5),
    "kana": Band(0.7, 4.0, 0.3, 4.6, 0.5),
    "han": Band(0.5, 3.0, 0.6, 4.5, 0.5),
    "hangul": Band(0.5, 3.0, 0.5, 4.3, 0.5),
    "rare": Band(0.28, 4.0, 1.0, 3.0, 0.4),
    "other": Band(0.4, 1.1, 0.3, 3.0),
}
# First and last code point of the ranges that count for a script.
RANGES = [
    ("latin", 0x41, 0x5A), ("latin", 0x61, 0x7A), ("latin", 0xC0, 0xFF), ("toned", 0x100, 0x24F), ("toned", 0x300, 0x36F),
    ("toned", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F),
    ("gujarati", 0xA80, 0xAFF), ("odia", 0xB00, 0xB7F), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("sinhala", 0xD80, 0xDFF), ("thai", 0xE00, 0xE7F),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("hangul", 0x1100, 0x11FF),
    ("hangul", 0xAC00, 0xD7AF),
]
TONED_PERCENT = 3  # share of letters beyond Latin-1 that makes a Latin text toned
SCRIPTS = [*dict.fromkeys(name for name, _, _ in RANGES), "rare", "other"]

_OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
        "script string, chars_per_token double, byte_share double, token_entropy double, base_failed boolean, kept boolean")


@lru_cache(maxsize=1)
def _script_of() -> np.ndarray:
    table = np.full(0x110000, SCRIPTS.index("other"), np.uint8)
    table[[p for p in range(0x110000) if chr(p).isalpha()]] = SCRIPTS.index("rare")
    for name, a, b in RANGES:
        table[a:b + 1] = SCRIPTS.index(name)
    return table


def script(text: str) -> str:
    """The script with most characters in a text; of equals the one listed first."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "other"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = np.bincount(_script_of()[points], minlength=len(SCRIPTS))[:-1]
    latin, toned = SCRIPTS.index("latin"), SCRIPTS.index("toned")
    marked, n[latin], n[toned] = n[toned], n[latin] + n[toned], 0
    name = SCRIPTS[int(n.argmax())] if n.any() else "other"
    return "toned" if name == "latin" and 100 * marked >= TONED_PERCENT * n[latin] else name


def dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def base_counts(texts: list[str]) -> dict[str, np.ndarray]:
    words, n = Words(texts), len(texts)
    in_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[words.text_start])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    window, text = words.windows(WINDOW)
    repeated = np.zeros(len(words) + 1, np.int64)
    if len(window):
        # Windows of different texts are different: the text's number is mixed in.
        key = window ^ (text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, which, often = np.unique(key, return_inverse=True, return_counts=True)
        at = words.window_at[often[which] > 1]
        np.add.at(repeated, at, 1)
        np.add.at(repeated, at + WINDOW, -1)
    covered = np.cumsum(repeated)[:-1] > 0
    of_word = np.repeat(np.arange(n), words.per_text)
    return {
        "n_words": words.per_text,
        "word_chars": in_text(words.in_word & ((words.data & 0xC0) != 0x80)),
        "n_symbols": in_text(symbol[words.data]),
        "n_dup_lines": np.array([dup_lines(t) for t in texts], np.int64),
        "n_repeat_words": np.bincount(of_word[covered], minlength=n),
    }


@lru_cache(maxsize=2)
def _pieces(model: bytes):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    return sp, np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])


def measure(docs: DataFrame, model: bytes, text: str = "text", bands: Mapping[str, Band] = BANDS) -> DataFrame:
    """Every row and column of ``docs`` with the counts, the fertility figures and the verdict added.

    Null is an empty text: no words, no tokens, figures 0, so it fails the base. Added columns replace
    columns of the same name. Each row is judged alone, so repeated rows get equal verdicts, and an
    empty table gives an empty one. ``model`` is a sentencepiece model with byte fallback.
    """
    added = [c.split(" ")[0] for c in _OUT.split(", ")]
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, is_byte = _pieces(shared.value)
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            found = base_counts(texts)
            tokens, chars, bytes_, entropy = (np.zeros(len(texts)) for _ in range(4))
            scripts = [script(t) for t in texts]
            for i, t in enumerate(texts):
                ids = np.array(sp.encode(t, num_threads=1), np.int64)
                if len(ids):
                    share = np.bincount(ids)
                    share = share[share > 0] / len(ids)
                    tokens[i], bytes_[i] = len(ids), is_byte[ids].mean()
                    chars[i], entropy[i] = found["word_chars"][i] / len(ids), max(0.0, -(share * np.log2(share)).sum())
            base = (found["n_words"] < MIN_WORDS) | (100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"])
            own = [bands.get(s, bands["other"]) for s in scripts]
            column = lambda name: np.array([getattr(b, name) for b in own])
            floor = np.minimum(column("entropy"), column("entropy_share") * np.log2(np.maximum(tokens, 1)))
            short = np.array([b.least_chars if b.least_short is None else b.least_short for b in own])
            least = np.where(tokens < SHORT, short, column("least_chars"))
            fits = ((chars >= least) & (chars <= column("most_chars"))
                    & (bytes_ <= column("most_bytes")) & (entropy >= floor))
            out = {**found, "n_tokens": tokens.astype(np.int64), "script": scripts, "chars_per_token": chars,
                   "byte_share": bytes_, "token_entropy": entropy, "base_failed": base, "kept": ~base & fits}
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(out[c]) for c in added)], [*batch.schema.names, *added])

    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{names}, {_OUT}")
