"""Encoding and decoding with a SentencePiece model of merge type.

Encoding finds, from left to right, the longest piece that stands at each position (an Aho-Corasick automaton over the
reversed pieces gives them all in one pass), and takes shorter prefixes and then earlier pieces back whenever two
neighbours are not what the merges would leave. Two pieces can be neighbours if merging their characters anew gives
just the two. A sequence of pieces whose neighbours all fit is the one that merging gives, so the first one found is
exact. Positions from where no way leads on are marked in a bitfield and never tried twice.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fathom.llm.common import tidy

SPACE = "▁"
#: Entries that a task's memory of chunks, and of pairs of pieces, may have; a full one is emptied.
REMEMBERED = 200_000
#: The same where a worker forgets them at a task's end, to leave memory to other stages.
BRIEFLY = 100_000
#: Rows whose ids are held at once.
ROWS = 500
_NEVER = float("-inf")


class MergeModel:
    """The pieces of a model file with identity normalisation, a leading space and byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.unknown = model.unk_id()
        self.bytes = {i: int(self.pieces[i][3:5], 16) for i in range(n) if model.is_byte(i)}
        self.byte_id = {v: k for k, v in self.bytes.items()}
        self.special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i)}
        self.score = {self.pieces[i]: model.get_score(i) for i in range(n) if i not in self.bytes and i not in self.special and not model.is_unused(i)}
        self.ids = {p: model.piece_to_id(p) for p in self.score}
        self.plain = set(self.ids.values())
        self.known = {c for p in self.score for c in p}
        self.longest = ahocorasick.Automaton()
        for p in self.score:
            self.longest.add_word(p[::-1], p)
        self.longest.make_automaton()
        #: For each piece the longest piece that is a proper prefix.
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.score), None) for p in self.score}
        self.surface = [p.replace(SPACE, " ") for p in self.pieces]
        self.fits: dict[tuple[str, str], bool] = {}
        self.brief = False
        # A chunk is spaces and what follows up to the next one. No piece has a space after another character and none
        # has a line end or tab, so merges never cross these borders.
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("pieces with inner spaces are not supported")
        ends = "".join(c for c in "\n\t" if c not in self.known)
        self.chunk = re.compile(f"{SPACE}+[^{SPACE}{ends}]*|[{ends}]|[^{SPACE}{ends}]+" if ends else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.seen: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.odd: dict[str, str] = {}

    def merged(self, text: str) -> list[str]:
        """What merging leaves of the characters: again and again the pair with the best score, the leftmost first."""
        parts, get = list(text), self.score.get
        pairs = [get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs:
            best = max(pairs)
            if best == _NEVER:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], _NEVER)
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], _NEVER)
        return parts

    def fit(self, left: str, right: str) -> bool:
        """Whether merging leaves these two as neighbours; left is empty for the first piece."""
        key = (left, right)
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) > self.room():
                self.fits.clear()
            found = self.fits[key] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def split(self, text: str) -> list[str]:
        """The pieces of a text whose characters are all known."""
        n = len(text)
        # Matches come by their end in the reversed text, the longest of each end first: the dict keeps that one.
        longest = dict(reversed(list(self.longest.iter(text[::-1]))))
        fits, shorter = self.fits, self.shorter
        failed, out, at, left, piece = 0, [], 0, "", longest[n - 1]
        while True:
            end = at + len(piece)
            if not failed >> end & 1:
                fit = fits.get((left, piece))
                if fit is None:
                    fit = self.fit(left, piece)
                if fit:
                    out.append(piece)
                    if end == n:
                        return out
                    at, left, piece = end, piece, longest[n - 1 - end]
                    continue
            piece = shorter[piece]
            while piece is None:  # no way on from here: take the last piece back
                failed |= 1 << at
                last = out.pop()
                at -= len(last)
                left = out[-1] if out else ""
                piece = shorter[last]

    def encode_chunk(self, chunk: str) -> list[int]:
        if self.known.issuperset(chunk):
            return [self.ids[p] for p in self.split(chunk)]
        out: list[int] = []
        at = 0
        while at < len(chunk):
            end = at
            while end < len(chunk) and chunk[end] in self.known:
                end += 1
            if end > at:
                out += [self.ids[p] for p in self.split(chunk[at:end])]
            if end < len(chunk):
                out += [self.byte_id[b] for b in chunk[end].encode("utf-8")] if self.byte_id else [self.unknown]
                end += 1
            at = end
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids, with the space that leads every non-empty encoding."""
        if self.plain.issuperset(ids):
            return "".join([self.surface[i] for i in ids])
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.bytes:
                raw.append(self.bytes[i])
                continue
            if raw:
                out.append(_readable(bytes(raw)))
                raw.clear()
            out.append(self.surface[i] if i not in self.special else " ⁇ " if i == self.unknown else "")
        if raw:
            out.append(_readable(bytes(raw)))
        return "".join(out)

    def of_chunk(self, chunk: str) -> str:
        """The chunk's ids, joined by commas; remembers them, and in self.odd what they decode to if not the chunk."""
        joined = self.older.get(chunk)
        if joined is None:
            ids = self.encode_chunk(chunk)
            joined = ",".join(map(str, ids))
            decoded = self.decode(ids)
            if decoded != chunk.replace(SPACE, " "):
                self.odd[chunk] = decoded
                return joined
        if len(chunk) <= 64:
            if len(self.seen) >= self.room():  # what was not asked for during a whole generation goes
                self.older, self.seen = self.seen, {}
            self.seen[chunk] = joined
        return joined

    def encode_text(self, text: str | None) -> tuple[str, str]:
        """A whole text's ids, joined by commas, and the text that they decode to."""
        if not text:
            return "", ""
        self.odd.clear()
        chunks = self.chunk.findall(SPACE + text.replace(" ", SPACE))
        get, make = self.seen.get, self.of_chunk
        joined = [get(c) or make(c) for c in chunks]
        decoded = [self.odd.get(c) or c.replace(SPACE, " ") for c in chunks] if self.odd else None
        return ",".join(joined), ("".join(decoded) if decoded else "".join(chunks).replace(SPACE, " "))[1:]

    def room(self) -> int:
        """Entries that each memory may have."""
        return min(BRIEFLY, REMEMBERED) if self.brief else REMEMBERED

    def forget(self) -> None:
        """Drops all that was remembered; results stay the same."""
        self.seen, self.older, self.odd, self.fits = {}, {}, {}, {}

    def encode(self, text: str | None) -> list[int]:
        ids, _ = self.encode_text(text)
        return [int(x) for x in ids.split(",")] if ids else []


def _readable(raw: bytes) -> str:
    """Bytes as UTF-8; each byte that is no part of a character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode("utf-8") + "�")
            at += e.start + 1
    return "".join(out)


_models: dict[str, MergeModel] = {}


def load(path: str) -> MergeModel:
    """The model of a worker process; made once."""
    if path not in _models:
        _models[path] = MergeModel(path)
    return _models[path]


def encoded(docs: DataFrame, model_path: str, ids: bool = True, forget: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of `docs`, and with ids=True also the ids (array<int>).

    The model file is read where the tasks run, so model_path must be there on each machine. Null texts count as empty:
    no ids. Texts of any length are encoded whole; repeated rows each; an empty table gives an empty result; other
    columns are ignored. A narrow map: no shuffle. With forget=True a worker drops at the end of each task what it remembers
    of chunks, and remembers fewer: it has more memory for other stages, but the next task starts anew.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(model_path)
        model.brief = forget
        try:
            for whole in batches:
                for begin in range(0, len(whole), ROWS):  # few rows at once, as the ids take more memory than the texts
                    batch = whole.slice(begin, ROWS)
                    n, a, b, lists = [], [], [], []
                    for t in batch.column(1):
                        joined, decoded = model.encode_text(t.as_py())
                        n.append(joined.count(",") + 1 if joined else 0)
                        a.append(hashlib.sha256(joined.encode()).hexdigest())
                        b.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                        if ids:
                            lists.append(np.fromstring(joined, np.int32, sep=",") if joined else np.zeros(0, np.int32))
                    columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                    if ids:
                        edges = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(lists))))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            if forget:
                model.forget()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(tidy(run), schema)
