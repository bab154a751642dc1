"""Quality rules: repetition counts and compression bands of whole documents and of fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from fathom.llm.common import tidy

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """Limits of the compression ratio (bytes / compressed bytes) by length in bytes.

    limits: (from this many bytes on, least ratio, largest ratio). Prose gets more compressible as it gets longer,
    so both limits rise; a text below 64 bytes is mostly frame and is not judged.
    A document is rejected if its own ratio is out of its band, or if more than `share` of its chunks' bytes are in
    chunks out of theirs (the last chunk is judged by its own length).
    """

    level: int = 3
    chunk: int = 4096
    share: float = 0.5
    limits: tuple[tuple[int, float, float], ...] = field(
        default=((0, 0.0, 1e9), (64, 0.5, 2.0), (128, 0.9, 2.3), (256, 1.05, 2.6), (512, 1.15, 3.0), (1024, 1.2, 3.4), (2048, 1.25, 3.8), (4096, 1.25, 4.2), (16384, 1.25, 4.8))
    )

    def inside(self, n: int, ratio: float) -> bool:
        least, most = next((a, b) for start, a, b in reversed(self.limits) if n >= start)
        return least <= ratio <= most


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words in windows of `width` words that stand twice or more in the text, the first one included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(width):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[i : i + n]
    order = np.argsort(key, kind="stable")
    equal = key[order[1:]] == key[order[:-1]]
    if not equal.any():
        return 0
    a, b = order[1:][equal], order[:-1][equal]
    if any((ids[a + i] != ids[b + i]).any() for i in range(width)):  # a collision of keys: compare the windows themselves
        windows = np.lib.stride_tricks.sliding_window_view(ids, width)
        _, where, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        twice = count[where.reshape(-1)] > 1
    else:
        twice = np.zeros(n, bool)
        twice[a] = True
        twice[b] = True
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def in_bands(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> bool:
    n = len(text)
    if not n:
        return True
    if not bands.inside(n, n / len(packer.compress(text))):
        return False
    if n <= bands.chunk:
        return True
    out = 0
    for at in range(0, n, bands.chunk):
        part = text[at : at + bands.chunk]
        if not bands.inside(len(part), len(part) / len(packer.compress(part))):
            out += len(part)
    return out <= bands.share * n


def judge(text: str | None, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[int, int, int, int, int, bool, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()  # bytes are split at the six white-space bytes alone
    n = len(words)
    repeats = repeated_words(words)
    failed = n < 10 or 100 * repeats > 20 * n
    return n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), duplicate_lines(raw), repeats, failed, not failed and in_bands(raw, bands, packer)


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:  # noqa: B008
    """One row per row of `docs` (doc_id, text): the base counts, whether they fail, and whether the document is kept.

    kept is false where the base fails (fewer than 10 words, or over 20 % of the words in repeated 5-word windows),
    else it is the verdict of the compression bands. Null and empty texts have all counts 0 and fail; repeated rows
    are judged each; an empty table gives an empty result; other columns are ignored. A narrow map: no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            found = list(zip(*(judge(t.as_py(), bands, packer) for t in batch.column(1)), strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(found, kinds, strict=True))], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(tidy(run), SCHEMA)


def keep_good(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:  # noqa: B008
    """The rows of `docs` that quality() keeps, with all their columns."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            yield batch.filter(pa.array([judge(t.as_py(), bands, packer)[-1] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
