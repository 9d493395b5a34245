"""Byte-pair encoding by a public tokenizer file, with reuse of what has been encoded before.

``Encoder`` gives exactly the ids of the tokenizers library for whole texts. Between a character that is no white
space and a following ASCII white-space character the pre-tokenizer always cuts, as between ASCII letters or digits and
signs (but not behind an apostrophe, nor at signs that added tokens hold), so a text falls into pieces that can be
encoded apart; equal pieces are encoded once, and their ids are kept, in bounded memory, for the worker's life.

``encode`` reuses whole passages across the corpus: a rolling hash cuts texts into chunks by content alone, chunks that
stand more than once are encoded once, and the joins between chunks are mended by encoding a window around them again.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import lookups
from millrace.llm.tables import parts_for, text_bytes
from millrace.llm.texts import BYTE_HASH, SEPARATOR, Texts, U, binary

#: Pieces that a worker remembers; beyond that it starts over with those at hand.
MEMORY = 1_000_000
TABLE_BITS = 22
_JOINED = 1 << 11  # bytes of pieces handed to the tokenizer as one text


#: Bytes that are a character which is surely no white space: ASCII letters, digits and signs.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_WORD = np.zeros(256, bool)
_WORD[[b for b in range(128) if chr(b).isalnum()]] = True


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for U+0100 onwards."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(4)
def encoder(path: str | None = None) -> Encoder:
    """One encoder per worker and tokenizer file."""
    return Encoder(path or default_path())


def after_solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place is surely no white space."""
    before = data[at - 1]
    lead = data[np.maximum(at - 2, 0)]
    # Two-byte characters from U+00C0 on hold no white space.
    wide = (at >= 2) & (before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead < 0xE0)
    return _SOLID[before] | wide


def cuts(data: np.ndarray) -> np.ndarray:
    """Places that every encoding of a text with these bytes cuts at."""
    at = np.flatnonzero(SEPARATOR[data])
    at = at[at > 0]
    return at[after_solid(data, at)]


class Encoder:
    """Encodes and decodes whole texts; byte-level tokenizers without prefix space or normalizer."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte_of = _byte_of_char()
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        # Signs that no added token holds, and bytes that may stand behind a line's end without changing it.
        self.signs, self.heads = _SOLID & ~_WORD, _SOLID.copy()
        for content in filter(None, special.values()):
            self.signs[list(content.encode())] = False
            self.heads[content.encode()[0]] = False
        words = sorted((i, w) for w, i in self.tokenizer.get_vocab(with_added_tokens=True).items())
        size = words[-1][0] + 1
        spelled = [b""] * size
        for i, w in words:
            spelled[i] = special[i].encode() if i in special else bytes(map(byte_of.__getitem__, w))
        self.width = np.fromiter(map(len, spelled), np.int64, size)
        self.spelling = np.frombuffer(b"".join(spelled), np.uint8)
        self.place = np.cumsum(self.width) - self.width
        self.forget()

    def forget(self) -> None:
        # A row of no piece comes first; ``table`` has the row of the last piece with these high bits of the key.
        self.keys, self.first, self.count = np.zeros(1, U), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.table = np.zeros(1 << TABLE_BITS, np.int32)

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """As the function ``cuts``, and between words and signs."""
        word, sign = _WORD[data], self.signs[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = (word[:-1] & sign[1:]) | (sign[:-1] & word[1:] & (data[:-1] != ord("'")))
        cut[cuts(data)] = True
        return np.flatnonzero(cut)

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts],
                                                 add_special_tokens=False)
        return [np.array(f.ids, np.uint32) for f in found]

    def _learn(self, texts: Texts, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encodes pieces with new keys and remembers them."""
        data = texts.data
        # Pieces may stand next to each other in one text if they start with white space and end without; a line's end,
        # always a token of its own there, is put before those that start with a sign or word.
        closed, spaced = after_solid(data, ends), SEPARATOR[data[starts]]
        joins, lined = closed & (spaced | self.heads[data[starts]]), closed & ~spaced & self.heads[data[starts]]
        raw = data.tobytes()
        pieces = [b"\n" + raw[a:b] if line else raw[a:b]
                  for a, b, line in zip(starts.tolist(), ends.tolist(), lined.tolist(), strict=True)]
        count = np.zeros(len(keys), np.int64)
        # Alone: those that start or end a text in a way that neighbours could change.
        alone = np.flatnonzero(~joins)
        ids = self._plain([pieces[i] for i in alone])
        count[alone] = [len(s) for s in ids]
        # Together, cut apart again by the widths of the tokens.
        many = np.flatnonzero(joins)
        width = ends[many] - starts[many] + lined[many]
        batch = np.cumsum(width) // _JOINED
        bounds = np.append(np.flatnonzero(np.diff(batch, prepend=-1)), len(many)) if len(many) else np.zeros(1, int)
        texts_ = [b"".join([pieces[i] for i in many[a:b].tolist()]) for a, b in zip(bounds, bounds[1:], strict=False)]
        for at in range(0, len(texts_), 1024):
            got = np.concatenate(self._plain(texts_[at: at + 1024]))
            here = slice(bounds[at], bounds[min(at + 1024, len(texts_))])
            ends_ = np.searchsorted(np.cumsum(self.width[got]), np.cumsum(width[here])) + 1
            count[many[here]] = np.diff(ends_, prepend=0)
            ids.append(got)
        order = np.concatenate([alone, many])
        first = np.zeros(len(keys), np.int64)
        first[order] = np.cumsum(count[order]) - count[order] + len(self.ids)
        first, count = first + lined, count - lined
        self.ids = np.concatenate([self.ids, *ids])
        self.table[keys >> U(64 - TABLE_BITS)] = np.arange(len(self.keys), len(self.keys) + len(keys))
        self.keys, self.first, self.count = (
            np.concatenate(p) for p in ((self.keys, keys), (self.first, first), (self.count, count)))

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the index of each text's first id (n + 1)."""
        out, first = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for _, _, part in texts.slices(1 << 22):
            ids, at = self._slice(part)
            first.append(at[1:] + first[-1][-1])
            out.append(ids)
        return np.concatenate(out), np.concatenate(first)

    def _slice(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts.data):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        starts = texts.with_starts(self.cuts(texts.data))
        ends = np.append(starts[1:], len(texts.data))
        keys = texts.hashes(starts, ends)
        if len(self.keys) > MEMORY:
            self.forget()
        place = self.table.take((keys >> U(64 - TABLE_BITS)).view(np.int64)).astype(np.int64)
        missed = np.flatnonzero((self.keys.take(place) != keys) | (place == 0))
        if len(missed):
            new, one, which = np.unique(keys[missed], return_index=True, return_inverse=True)
            one = missed[one]
            place[missed] = len(self.keys) + which
            self._learn(texts, new, starts[one], ends[one])
        count = self.count[place]
        total = np.cumsum(count)
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.first[place] - total + count, count)]
        piece = np.searchsorted(starts, texts.offsets)
        return ids, np.append(0, total)[piece]

    def spell(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the tokens end to end."""
        width = self.width[ids]
        total = np.cumsum(width)
        return self.spelling[np.arange(total[-1] if len(ids) else 0) + np.repeat(self.place[ids] - total + width, width)]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become U+FFFD."""
        raw = self.spell(ids).tobytes()
        return raw.decode("utf-8", "replace").encode()


# ---- Content-defined chunks --------------------------------------------------------------------------------------

WINDOW = 32  # bytes that decide a cut
CUT_BITS = 9  # chunks of about 512 bytes
_GEAR = (BYTE_HASH >> U(32)).astype(np.uint32)


def chunks(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all chunks, and the index of each text's first chunk (n + 1).

    A text is cut where the rolling hash of the 32 bytes before is small, always before a whole character.
    """
    data, n = texts.data, len(texts.data)
    rolling = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        rolling[k:] = rolling[k:] + (rolling[:-k] << np.uint32(k))
    at = np.flatnonzero(rolling >> np.uint32(32 - CUT_BITS) == 0) + 1
    at = at[at < n]
    at = at[(data[at] & 0xC0) != 0x80]
    owner = np.searchsorted(texts.offsets, at, "right") - 1
    at = at[at - texts.offsets[owner] >= WINDOW]
    starts = texts.with_starts(at)
    return starts, np.append(starts[1:], n)[: len(starts)], np.searchsorted(starts, texts.offsets)


def _ends_of_tokens(enc: Encoder, ids: np.ndarray) -> np.ndarray:
    return np.cumsum(enc.width[ids])


def assemble(texts: Texts, known: dict[int, np.ndarray], enc: Encoder) -> list[np.ndarray]:
    """Ids of each text, from the ids of its known chunks and of the stretches between them.

    Parts are encoded apart, so the ids next to a join may be wrong. Around each join the text from the last sure cut
    of the part before to the first of the part after is encoded again; a cut counts only if the part's ids end a
    token there, else the window grows to the next one, at most to the ends of the text.
    """
    starts, ends, first = chunks(texts)
    keys = texts.hashes(starts, ends).tolist()
    raw = texts.data.tobytes()
    sure = cuts(texts.data)
    plan: list[list[tuple[int, int, np.ndarray | int]]] = []  # per text: (start, end, ids or number of its stretch)
    stretches: list[bytes] = []
    for i in range(len(texts)):
        parts: list[tuple[int, int, np.ndarray | int]] = []
        for j in range(first[i], first[i + 1]):
            a, b = int(starts[j]), int(ends[j])
            ids = known.get(keys[j])
            if ids is not None:
                parts.append((a, b, ids))
            elif parts and isinstance(parts[-1][2], int):
                parts[-1] = (parts[-1][0], b, parts[-1][2])
            else:
                parts.append((a, b, len(stretches)))
                stretches.append(b"")
            if isinstance(parts[-1][2], int):
                stretches[parts[-1][2]] = raw[parts[-1][0]: b] if j + 1 == first[i + 1] or keys[j + 1] in known else b""
        plan.append(parts)
    ids, at = enc.encode(Texts.from_list(stretches))
    # What stays of each part, and the windows to encode again.
    kept: list[list[np.ndarray | int]] = []
    windows_: list[bytes] = []
    for i, parts in enumerate(plan):
        out: list[np.ndarray | int] = []
        open_from = None  # start of the window that is not closed yet
        for k, (a, b, got) in enumerate(parts):
            got = ids[at[got]: at[got + 1]] if isinstance(got, int) else got
            if len(parts) == 1:
                out.append(got)
                break
            stops = _ends_of_tokens(enc, got) + a
            inside = sure[np.searchsorted(sure, a, "right"): np.searchsorted(sure, b, "left")]
            agreed = inside[stops[np.minimum(np.searchsorted(stops, inside), len(stops) - 1)] == inside]
            low = a if k == 0 else (int(agreed[0]) if len(agreed) else None)
            high = b if k + 1 == len(parts) else (int(agreed[-1]) if len(agreed) else None)
            if k + 1 == len(parts) and low is None:
                high = None
            if k == 0 and high is None:
                low = None
            if low is None or high is None:
                open_from = a if open_from is None else open_from
                continue
            if open_from is not None:
                out.append(len(windows_))
                windows_.append(raw[open_from:low])
            out.append(got[np.searchsorted(stops, low, "right") if low > a else 0: np.searchsorted(stops, high) + 1])
            open_from = None if k + 1 == len(parts) else high
        if open_from is not None:
            out.append(len(windows_))
            windows_.append(raw[open_from: texts.offsets[i + 1]])
        kept.append(out)
    ids, at = enc.encode(Texts.from_list(windows_))
    none = np.zeros(0, np.uint32)
    return [np.concatenate([none, *(ids[at[p]: at[p + 1]] if isinstance(p, int) else p for p in out)]) for out in kept]


def _packed(ids: np.ndarray) -> bytes:
    """Ids in two bytes each where they fit, else in four; the first byte tells."""
    small = not len(ids) or ids.max() < 1 << 16
    return b"\2" + ids.astype("<u2").tobytes() if small else b"\4" + ids.astype("<u4").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2" if data[0] == 2 else "<u4", offset=1).astype(np.uint32)


def _keys_of(group: pa.Table) -> pa.Table:
    texts = lookups.texts_of(group)
    starts, ends, _ = chunks(texts)
    keys, count = np.unique(texts.hashes(starts, ends), return_counts=True)
    block = group.column("block")[0].as_py()
    return pa.Table.from_arrays(
        [pa.array(keys.view(np.int64)), pa.array([block] * len(keys), pa.int32()), pa.array(count)],
        names=["chunk", "block", "n"])


def encode(docs: DataFrame, finish: Callable[[Encoder, list[np.ndarray]], dict[str, pa.Array]], columns: str,
           keep: list[str], text: str = "text", path: str | None = None, block_bytes: int = 4 << 20) -> DataFrame:
    """The columns ``keep`` and what ``finish`` makes of the rows' ids (``columns`` names and types it).

    A chunk that stands more than once in the corpus is encoded by one block only, its ids go to every block that
    holds it. Unshared text never leaves its block. The text is shuffled once; the plan's branches share that shuffle.
    Null counts as empty; a repeated row gives a row each time; an empty table gives an empty result.
    """
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(text).alias("text"))
    n = parts_for(text_bytes(rows), block_bytes)
    blocked = lookups.dealt(rows, n, "kept", "text")
    held = blocked.groupBy("block").applyInArrow(_keys_of, "chunk bigint, block int, n bigint")
    shared = held.groupBy("chunk").agg(F.min("block").alias("block"), F.sum("n").alias("n")).filter("n > 1").drop("n")

    def encode_own(group: pa.Table, own: pa.Table) -> pa.Table:
        texts = lookups.texts_of(group)
        starts, ends, _ = chunks(texts)
        keys, one = np.unique(texts.hashes(starts, ends).view(np.int64), return_index=True)
        mine = one[np.searchsorted(keys, own.column("chunk").to_numpy())] if len(own) else one[:0]
        raw = texts.data.tobytes()
        ids, at = encoder(path).encode(Texts.from_list([raw[starts[i]: ends[i]] for i in mine]))
        return pa.Table.from_arrays(
            [own.column("chunk"), binary([_packed(ids[a:b]) for a, b in zip(at, at[1:], strict=False)])],
            names=["chunk", "ids"])

    coded = blocked.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        encode_own, "chunk bigint, ids binary")
    sent = held.select("chunk", "block").join(coded, "chunk")

    def finish_block(group: pa.Table, got: pa.Table) -> pa.Table:
        known = {k & 0xFFFFFFFFFFFFFFFF: _unpacked(v.as_py())
                 for k, v in zip(got.column("chunk").to_pylist(), got.column("ids"), strict=True)}
        enc = encoder(path)
        made = finish(enc, assemble(lookups.texts_of(group), known, enc))
        kept = group.column("kept").combine_chunks()
        return pa.Table.from_arrays([*kept.flatten(), *made.values()], names=[*keep, *made])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return blocked.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(finish_block, f"{kinds}, {columns}")


def ids_column(enc: Encoder, ids: list[np.ndarray]) -> dict[str, pa.Array]:
    return {"n_tokens": pa.array([len(i) for i in ids], pa.int64()),
            "ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32()))}


def encoded(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """The columns ``keep``, n_tokens and ids of each row's whole text."""
    return encode(docs, ids_column, "n_tokens bigint, ids array<int>", keep, text, path)


def decoded(rows: DataFrame, ids: str = "ids", out: str = "text", path: str | None = None) -> DataFrame:
    """``rows`` with the text of the column ``ids``; null stays null."""

    @F.pandas_udf("string")
    def spell(column):
        enc = encoder(path)
        return column.map(lambda i: enc.decode(np.asarray(i, np.int64)).decode(), na_action="ignore")

    return rows.withColumn(out, spell(F.col(ids)))


def digests(enc: Encoder, ids: list[np.ndarray]) -> dict[str, pa.Array]:
    """Number and hashes of the ids and of the text decoded from them."""
    sha = hashlib.sha256
    return {"n_tokens": pa.array([len(i) for i in ids], pa.int64()),
            "ids_sha256": pa.array([sha(",".join(map(str, i.tolist())).encode()).hexdigest() for i in ids], pa.string()),
            "decoded_sha256": pa.array([sha(enc.decode(i)).hexdigest() for i in ids], pa.string())}


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    return encode(docs, digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", ["doc_id"], path=path)
