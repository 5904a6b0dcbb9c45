"""Quality rules by tokeniser fertility.

Public vocabularies, trained on ordinary text, cut ordinary prose into long
tokens and noise into short ones.  Per document this measures

* characters (symbols left out) per token of a byte-level vocabulary,
* characters per token and the share of byte-fallback tokens of a
  sentencepiece vocabulary, over the document's words,
* the entropy of the byte-level tokens, as a share of the most it could be for
  as many tokens,

and rejects a document whose measures leave the band of its language, or of
its main script if the language has no band.  A few plain counts (words,
symbols, repeated lines and phrases) come first and fail short or repetitive
documents at once.  Everything is per row, so the work is one pass without a
shuffle, and rejected documents go where they are found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import col, map_batches, slices, text_bytes
from basketry.llm.tokens import encoder, piece_words, raw


@dataclass(frozen=True)
class Band:
    """Documents outside are rejected."""

    chars_per_token: tuple[float, float]
    piece_chars: tuple[float, float]
    max_fallback: float
    entropy: tuple[float, float]


#: Rejection bands.  Where a language is named, its lower bounds were fitted on
#: a bounded sample of about 20,000 labelled documents: some 3% below the least
#: of the good ones, so that clean documents stay.  Prose that a vocabulary was trained on has about
#: four characters a token, far inside; symbol soup and runs of cell borders
#: fall below, since symbols cost tokens but do not count as characters.
#: Scripts a vocabulary hardly knows cost two to four byte tokens a character.
#: Entropy is 1 when no token repeats and nears 0 when few make up the text.
BANDS: Mapping[str, Band] = {
    "en": Band((1.78, 8.0), (1.76, 8.0), 0.05, (0.40, 0.995)),
    "de": Band((1.76, 8.0), (1.88, 8.0), 0.10, (0.40, 0.995)),
    "fr": Band((1.55, 8.0), (1.70, 8.0), 0.10, (0.40, 0.995)),
    "es": Band((1.56, 8.0), (1.65, 8.0), 0.10, (0.40, 0.995)),
    "Latin": Band((1.3, 8.0), (1.3, 8.0), 0.25, (0.40, 0.998)),
    "Cyrillic": Band((0.4, 6.0), (1.0, 8.0), 0.25, (0.35, 0.998)),
    "Greek": Band((0.4, 6.0), (0.6, 8.0), 0.60, (0.35, 0.998)),
    "Han": Band((0.25, 4.0), (0.25, 4.0), 0.98, (0.30, 0.999)),
    "Kana": Band((0.25, 4.0), (0.25, 4.0), 0.98, (0.30, 0.999)),
    "Hangul": Band((0.25, 4.0), (0.25, 4.0), 0.98, (0.30, 0.999)),
    "other": Band((0.2, 8.0), (0.2, 8.0), 1.0, (0.25, 1.0)),
}

#: First and last code point of the scripts above.
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
    "other": [(0x530, 0x10FF), (0x1200, 0x1DFF)],
}

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

MEASURES = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "kept": "boolean",
    "n_tokens": "long",
    "chars_per_token": "double",
    "piece_chars": "double",
    "fallback_share": "double",
    "token_entropy": "double",
    "band": "string",
    "reasons": "string",
}


def main_script(text: str) -> str:
    """The script with the most letters; "other" if none of them occurs."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = {name: sum(int(((points >= a) & (points <= b)).sum()) for a, b in spans) for name, spans in SCRIPTS.items()}
    best = max(counts, key=lambda k: counts[k])
    return best if counts[best] else "other"


def repeated_words(words: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` words that occur twice or more.
    ``words`` holds a number per word, equal for equal words."""
    n = words.size - window + 1
    if n < 2:
        return 0
    key = words[:n]
    for i in range(1, window):
        low = np.unique(key, return_inverse=True)[1] if key.size and key.max() >= 1 << 42 else key
        part = words[i : i + n]
        if part.max() >= 1 << 21:
            part = np.unique(part, return_inverse=True)[1]
        key = low * (int(part.max()) + 1) + part
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    same = sorted_[1:] == sorted_[:-1]
    if not same.any():
        return 0
    again = np.zeros(n, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(words.size, bool)
    for i in range(window):
        covered[i : i + n] |= again
    return int(covered.sum())


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[bounds])


def _repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def _entropy(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: entropy of its ids divided by the log of their number."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(sizes.size, dtype=np.int64), sizes)
    pair, count = np.unique((owner << 32) | ids, return_counts=True)
    lost = np.bincount(pair >> 32, weights=count * np.log2(count), minlength=sizes.size)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(sizes > 1, 1 - lost / (sizes * np.log2(sizes)), np.nan)


def measure(texts: pa.Array, langs: list[str | None], byte_path: str, piece_path: str, bands: Mapping[str, Band]) -> dict[str, list]:
    """The columns of ``MEASURES`` for a batch of texts; null counts as empty."""
    coder, pieces = encoder(byte_path, "lead"), piece_words(piece_path)
    data, bounds = raw(texts)
    blank = _SPACE[data]
    n_chars = _per_text(~blank & ((data & 0xC0) != 0x80), bounds)
    n_symbols = _per_text(_SYMBOL[data], bounds)
    number, starts = pieces.numbers(data, bounds)
    word_bounds = np.searchsorted(starts, bounds)
    n_words = np.diff(word_bounds)
    n_repeat = [repeated_words(number[a:b].astype(np.int64)) for a, b in zip(word_bounds[:-1].tolist(), word_bounds[1:].tolist())]
    n_lines = [_repeated_lines(t) for t in text_bytes(texts)]
    table = pieces.table
    fallback = np.add.reduceat(np.append(pieces.is_byte[table.ids[: table.used]], 0).astype(np.int64), table.begin[: table.count]) if table.count else np.zeros(0, np.int64)
    fallback[table.size[: table.count] == 0] = 0
    n_pieces = np.diff(np.concatenate(([0], np.cumsum(table.size[number].astype(np.int64))))[word_bounds])
    n_bytes = np.diff(np.concatenate(([0], np.cumsum(fallback[number])))[word_bounds])
    ids, id_bounds = coder.encode(texts)
    n_ids = np.diff(id_bounds)
    entropy = _entropy(ids, id_bounds)
    with np.errstate(divide="ignore", invalid="ignore"):
        useful = n_chars - n_symbols
        chars, piece_chars, share = useful / n_ids, useful / n_pieces, n_bytes / n_pieces
    out: dict[str, list] = {name: [] for name in MEASURES}
    plain = texts.to_pylist() if any(x not in bands for x in langs) else None
    for i, lang in enumerate(langs):
        failed = bool(n_words[i] < MIN_WORDS or 100 * n_repeat[i] > MAX_REPEAT_PERCENT * n_words[i])
        name = lang if lang in bands else main_script(plain[i] or "")
        band = bands[name]
        tests = {
            "chars_per_token": band.chars_per_token[0] <= chars[i] <= band.chars_per_token[1],
            "piece_chars": band.piece_chars[0] <= piece_chars[i] <= band.piece_chars[1],
            "fallback": share[i] <= band.max_fallback,
            "entropy": band.entropy[0] <= entropy[i] <= band.entropy[1],
        }
        broken = ["base"] if failed else [k for k, ok in tests.items() if not ok]
        row = (n_words[i], n_chars[i], n_symbols[i], n_lines[i], n_repeat[i], failed, not broken, n_ids[i], chars[i], piece_chars[i], share[i], entropy[i], name, ",".join(broken))
        for k, x in zip(MEASURES, row):
            out[k].append(None if isinstance(x, float) and not np.isfinite(x) else x)
    return out


_ARROW = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}


def _runner(byte_path: str, piece_path: str, bands: Mapping[str, Band], text: int, lang: int | None, emit: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "__text"):
            langs = [None] * b.num_rows if lang is None else b.column(lang).to_pylist()
            yield emit(b, measure(b.column(text).cast(pa.string()), langs, byte_path, piece_path, bands))

    return run


def quality(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text", lang: str | None = "lang", bands: Mapping[str, Band] = BANDS) -> DataFrame:
    """(key, the columns of ``MEASURES``), one row per row of ``docs``.

    ``kept`` is false if a base rule or the band rejects the document;
    ``reasons`` names what did.  Null or empty text has no words, so it fails
    the base rules; its ratios are null.  A null or unknown language is judged
    by the text's main script.  Repeated rows are judged alike; an empty table
    gives no rows; other columns of ``docs`` are not read."""
    slim = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text"), (F.col(lang).cast("string") if lang else F.lit(None).cast("string")).alias("__lang"))

    def emit(b: pa.RecordBatch, m: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[k], _ARROW[t]) for k, t in MEASURES.items())], [key, *MEASURES])

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"{k} {t}" for k, t in MEASURES.items())
    return map_batches(slim, _runner(byte_path, piece_path, bands, 1, 2, emit), schema)


def keep_quality(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", lang: str | None = "lang", bands: Mapping[str, Band] = BANDS) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, columns unchanged."""
    n = len(docs.columns)
    wide = docs.select(*[col(c) for c in docs.columns], F.col(text).cast("string").alias("__text"), (F.col(lang).cast("string") if lang else F.lit(None).cast("string")).alias("__lang"))
    inner = wide.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), "__text", "__lang")

    def emit(b: pa.RecordBatch, m: dict[str, list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0)], ["row"]).filter(pa.array(m["kept"], pa.bool_()))

    schema = inner.select("row").schema
    assert len(schema["row"].dataType) == n
    return map_batches(inner, _runner(byte_path, piece_path, bands, 1, 2, emit), schema).select("row.*")
