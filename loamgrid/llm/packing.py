"""Packing documents into fixed windows by minimum bin slack.

A document's tokens (its ids and an end id) are cut into full windows, which are sequences as they are, and a remainder. Remainders are written with a
number each and dealt by it into groups of a few thousand, so rows that are alike spread like any others; in each group, a window takes the longest remainder left and then the multiset of remaining lengths that comes closest to
its capacity, found by bitset subset-sum dynamic programming over the lengths' counts and read off by backtracking.
If even the closest multiset leaves slack, the next longest remainder is cut to fill it, so that only the last window of a group can have
padding; its tokens are split so that what lacks a full window ends at powers of two where that needs few pieces.

Null text is empty (one end id). Repeated rows, and rows of equal or null id, are packed each on their own; a text of any length is cut into its windows in one
task. An empty table gives an empty result; other columns, whatever their names, are ignored. Ids come from the byte-level BPE vocabulary file given as a parameter; strings
of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamgrid.llm.common import map_texts, read_documents, staged

WINDOW = 1024
END_ID = 0
#: Remainders of a group.
GROUP_DOCS = 2048
PIECES = "id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE writes bytes as printable characters: those that print stand for themselves, the rest follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from text to uint32 ids: the file's vocabulary in tiktoken, which gives the ids of the tokenizers library several times faster."""
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {x["content"] for x in model.get("added_tokens", [])}
    alphabet = _byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array(bpe.encode_ordinary(text), np.uint32)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, window: int, end_id: int) -> DataFrame:
    """Per document its full windows (digest only) and its remainder, with ids as little-endian uint32."""

    def run(texts: list[str | None]):
        encode = encoder(vocabulary)
        rows, out = [], []
        for i, text in enumerate(texts):
            ids = np.append(encode(text or ""), np.uint32(end_id))
            for start in range(0, len(ids), window):
                part = ids[start : start + window]
                rows.append(i)
                out.append((start, len(part), crc(part), len(ids), None if len(part) == window else part.astype("<u4").tobytes()))
        return rows, list(zip(*out, strict=True)) if out else [[]] * 5

    columns = [*[(c, "long", pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens")], ("ids", "binary", pa.binary())]
    return map_texts(docs, id_col, text_col, columns, run)


def fill(counts: dict[int, int], capacity: int) -> list[int]:
    """The multiset of lengths with the largest sum up to ``capacity``.

    Bit s of the bitset is set if sum s can be made. Counts are split into powers of two, so a length takes a few
    shifts; the bitset before each step tells, from the best sum backwards, whether the step was used.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, size = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(size, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            size *= 2
        if reach >> capacity & 1:
            break
    best = reach.bit_length() - 1
    chosen: list[int] = []
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            chosen += [length] * take
            best -= length * take
    return chosen


def pack_lengths(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Windows of ``(item, from, to)`` pieces, gapless, that cover all items; only the last window is not full."""
    stacks: dict[int, list[tuple[int, int]]] = {}
    for item, length in enumerate(lengths):
        if length:
            stacks.setdefault(length, []).append((item, 0))

    def pop(length: int) -> tuple[int, int, int]:
        item, start = stacks[length].pop()
        if not stacks[length]:
            del stacks[length]
        return item, start, start + length

    windows = []
    while stacks:
        pieces = [pop(max(stacks))]
        room = window - (pieces[0][2] - pieces[0][1])
        for length in fill({k: len(v) for k, v in stacks.items() if k <= room}, room) if room else []:
            pieces.append(pop(length))
            room -= length
        if room and stacks:  # all that is left is longer than the slack: cut the longest
            item, start, end = pop(max(stacks))
            pieces.append((item, start, start + room))
            stacks.setdefault(end - start - room, []).append((item, start + room))
        windows.append(pieces)
    if windows:
        windows[-1:] = _halve(windows[-1], window)
    return windows


def _halve(pieces: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """Cut the last window once: the largest power of two it fills needs no padding, the rest is padded to the window (or is a power of two)."""
    total = sum(b - a for _, a, b in pieces)
    size = 1 << (total.bit_length() - 1)
    if total in (size, window) or total - size >= window // 2:
        return [pieces]
    rest = total - size
    if rest & (rest - 1):  # one cut does not end the padding
        return [pieces]
    first, second, room = [], [], size
    for item, a, b in pieces:
        cut = min(b, a + room)
        if cut > a:
            first.append((item, a, cut))
        if b > cut:
            second.append((item, cut, b))
        room -= cut - a
    return [first, second]


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row per piece: id, ``start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, for remainders, ``ids``."""
    pieces = staged(token_pieces(docs, id_col, text_col, vocabulary or vocabulary_path(), window, end_id), "pieces")
    kind = pieces.schema["id"].dataType.simpleString()
    # odd sequence ids: full windows by number; even ones: windows of a group
    numbered = pieces.withColumn("number", F.monotonically_increasing_id())
    full = numbered.filter(F.col("length") == window)
    full = full.select("id", "start", "length", "ids_crc32", "doc_tokens", (F.col("number") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(None).cast("binary").alias("ids"))
    rest = numbered.filter(F.col("length") != window)
    groups = max(1, -(-rest.count() // group_docs))
    dealt = rest.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(groups)))

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(key: tuple, group: pa.Table) -> pa.Table:
        base = int(key[0].as_py()) << 32
        group = group.sort_by("number")
        starts = group["start"].to_pylist()
        ids = [np.frombuffer(x, "<u4") for x in group["ids"].to_pylist()]
        rows, out = [], []
        for seq, pieces in enumerate(pack_lengths(group["length"].to_pylist(), window), base):
            offset = 0
            for item, a, b in pieces:
                part = ids[item][a:b]
                rows.append(item)
                out.append((starts[item] + a, b - a, crc(part), 2 * seq, offset, part.tobytes()))
                offset += b - a
        start, length, digest, seq, offset, tokens = zip(*out, strict=True)
        of = group.take(pa.array(rows, pa.int64()))
        long = lambda v: pa.array(v, pa.int64())
        return pa.Table.from_arrays([of["id"], long(start), long(length), long(digest), of["doc_tokens"], long(seq), long(offset), pa.array(tokens, pa.binary())], names)

    packed = dealt.groupBy("part").applyInArrow(run, PIECES.format(id=kind)).unionByName(full)
    return packed.withColumnRenamed("id", id_col)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_documents(spark, sf_dir)).drop("ids")
