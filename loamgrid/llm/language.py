"""Language identification by cross-parsing entropy.

Each language has a bounded sample of labelled text and its suffix automaton. A text is parsed greedily into the longest phrases
that occur in a language's sample; the language that needs the fewest phrases, each weighed by the bits that point into
its sample, per byte, wins. The walk over the automaton, with a return to its root where a phrase ends, is itself one
transition table with phrase counts on its edges, so thousands of text segments take a step at once in numpy.

Texts are lower-cased, runs of non-letters become one space, and whole texts, as UTF-8 so that every script fits an alphabet of bytes, are parsed in segments of
``SEGMENT`` bytes. A null text or one without letters is ``und`` with score 0, as is every text if nothing is labelled. Ties
go to the first language by name; repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.

What is learned is bounded: the ``MAX_LANGUAGES`` most frequent labels, ``SAMPLE_DOCS`` documents and ``SAMPLE_BYTES`` bytes of each (fewer if
there are many languages), so neither the driver nor a worker's tables grow with the input or with a column of faulty labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loamgrid.llm.common import map_texts, read_documents

#: Bounds of the labelled sample: languages (the most frequent labels), documents per language, bytes per language, bytes of all languages.
MAX_LANGUAGES = 256
SAMPLE_DOCS = 48
SAMPLE_BYTES = 32_000
TOTAL_BYTES = 512_000
SEGMENT = 512
#: Bytes parsed at once in a task.
CHUNK_BYTES = 2_000_000
UNKNOWN = "und"
#: A text is close to no learned language if it needs more bits a byte than bytes have.
MAX_COST = 8.0
_COUNT_SHIFT = 28


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def normalise(text: str | None) -> np.ndarray:
    """UTF-8 of the lower-cased text with one space for each run of non-letters; empty if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.empty(0, np.uint8)
    letter = _letters()[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF).tolist():
        letter[i] = chr(points[i]).isalpha()
    if not letter.any():
        return np.empty(0, np.uint8)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first non-letter of a run stands for it
    kept = np.where(letter, points, 32).astype("<u4")[keep]
    if kept.max() < 0x80:
        return kept.astype(np.uint8)
    return np.frombuffer(kept.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)


class Automaton:
    """Transition table of the greedy parse against one sample."""

    def __init__(self, sample: str):
        points = normalise(sample)
        self.symbols = np.zeros(256, np.uint8)  # 0: a byte that the sample has not
        seen = np.unique(points)
        self.symbols[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        nxt = self._suffix_automaton(self.encode(points).tolist())
        root = np.zeros(self.width, np.int32)
        for c, s in nxt[0].items():
            root[c] = s
        # a missing edge ends the phrase and starts the next with this symbol; an unknown symbol is a phrase of its own
        table = np.tile(np.where(root > 0, root | (1 << _COUNT_SHIFT), 2 << _COUNT_SHIFT).astype(np.int32), (len(nxt), 1))
        table[0] = np.where(root > 0, root, 1 << _COUNT_SHIFT)
        for s, edges in enumerate(nxt):
            for c, t in edges.items():
                table[s, c] = t
        self.table = table.ravel()
        self.bits = math.log2(max(2, len(points)))

    @staticmethod
    def _suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
        nxt, link, length, last = [{}], [-1], [0], 0
        for c in symbols:
            cur = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    link[q] = link[cur] = clone
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
            last = cur
        return nxt

    def encode(self, points: np.ndarray) -> np.ndarray:
        return self.symbols[points]

    def phrases(self, segments: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each segment. ``segments[t]`` has symbol t of all segments, ordered by falling length; ``active[t]`` have one."""
        state = np.zeros(segments.shape[1], np.int64)
        count = np.zeros(segments.shape[1], np.int64)
        mask = (1 << _COUNT_SHIFT) - 1
        for t, n in enumerate(active.tolist()):
            code = self.table[state[:n] * self.width + segments[t, :n]]
            state[:n] = code & mask
            count[:n] += code >> _COUNT_SHIFT
        return count + (state > 0)


@lru_cache(maxsize=4)
def automata(samples: tuple[tuple[str, str], ...]) -> list[tuple[str, Automaton]]:
    """Built once per Python worker."""
    return [(lang, Automaton(text)) for lang, text in samples]


def classify(texts: list[str | None], samples: tuple[tuple[str, str], ...]) -> tuple[list[str], list[float], list[float]]:
    """Language, score (how much cheaper it is than the second best) and bits a byte of each text."""
    models = automata(samples)
    points = [normalise(t) for t in texts]
    lengths = np.array([len(p) for p in points], np.int64)
    langs, scores, bits = [UNKNOWN] * len(texts), [0.0] * len(texts), [math.inf] * len(texts)
    if not models or not lengths.any():
        return langs, scores, bits
    parts = -(-lengths // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    sizes = np.minimum(SEGMENT, lengths[owner] - nth * SEGMENT)
    order = np.argsort(-sizes, kind="stable")
    active = np.searchsorted(-sizes[order], -np.arange(SEGMENT), side="left")[: int(sizes.max())]
    flat = np.concatenate(points)
    at = (np.cumsum(lengths) - lengths)[owner] + nth * SEGMENT
    padded = np.concatenate((flat, np.zeros(SEGMENT, flat.dtype)))
    costs = []
    for _, model in models:
        symbols = model.encode(padded)
        segments = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(symbols, SEGMENT)[at[order]].T)
        counts = np.bincount(owner[order], weights=model.phrases(segments, active), minlength=len(texts))
        costs.append(counts * model.bits / np.maximum(lengths, 1))
    costs = np.array(costs)
    best = costs.argmin(axis=0)
    for i in np.flatnonzero(lengths).tolist():
        langs[i] = models[best[i]][0]
        second = min((costs[k, i] for k in range(len(models)) if k != best[i]), default=math.inf)
        scores[i] = float(1 - costs[best[i], i] / second) if second else 0.0
        bits[i] = float(costs[best[i], i])
    return langs, scores, bits


def classify_in_chunks(texts: list[str | None], samples: tuple[tuple[str, str], ...]) -> tuple[list[str], list[float], list[float]]:
    """``classify`` on runs of rows of about CHUNK_BYTES characters: bounded memory in a task."""
    out: tuple[list, list, list] = ([], [], [])
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK_BYTES or i + 1 == len(texts):
            for all_rows, found in zip(out, classify(texts[start : i + 1], samples), strict=True):
                all_rows += found
            start, size = i + 1, 0
    return out


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_samples(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> tuple[tuple[str, str], ...]:
    """Text per language: whole documents in a hash order, as many as fit the bounds.

    Documents longer than a language's bound come last; only where one of them is all there is, its text is cut.
    """
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull())
    counted = rows.groupBy(F.col(lang_col).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)  # the bound on labels
    langs = [r["lang"] for r in counted.collect()]
    bound = min(SAMPLE_BYTES, TOTAL_BYTES // max(1, len(langs)))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")
    ranked = rows.filter(F.col(lang_col).isin(langs)).select(
        F.col(lang_col).alias("lang"), (F.octet_length(F.coalesce(text_col, F.lit(""))) > bound).alias("long"), F.md5(name).alias("u"), F.xxhash64(text_col).alias("hash")
    )
    first = Window.partitionBy("lang").orderBy("long", "u", "hash")
    picked = ranked.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= SAMPLE_DOCS)
    picked = picked.select(F.col("lang").alias("_lang"), F.col("u").alias("_u"), F.col("hash").alias("_hash"), "n")
    text = rows.select(F.col(lang_col).alias("lang"), F.md5(name).alias("u"), F.xxhash64(text_col).alias("hash"), F.substring(F.col(text_col), 1, bound).alias("text"))
    # SAMPLE_DOCS rows of MAX_LANGUAGES languages at most
    found = text.join(F.broadcast(picked), (F.col("lang") == F.col("_lang")) & (F.col("u") == F.col("_u")) & (F.col("hash") == F.col("_hash")))
    by_lang: dict[str, str] = {}
    for r in found.select("lang", "n", "text").dropDuplicates(["lang", "n"]).orderBy("lang", "n").toLocalIterator():
        own, more = by_lang.get(r["lang"], ""), (r["text"] or "").encode("utf-8", "surrogatepass")[:bound].decode("utf-8", "ignore")
        if not own or len(f"{own}{more}".encode()) < bound:
            by_lang[r["lang"]] = f"{own}\n{more}" if own else more
    return tuple(sorted(by_lang.items()))


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``lang_pred, score``. Only the text and the samples are used."""

    columns = [("lang_pred", "string", pa.string()), ("score", "double", pa.float64())]
    return map_texts(docs, id_col, text_col, columns, lambda texts: (None, list(classify_in_chunks(texts, samples)[:2])), id_col)


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", languages: list[str] | None = None, max_cost: float = MAX_COST
) -> DataFrame:
    """The rows, with all their columns, whose text is in one of ``languages`` (None: any learned one); ``lang_col`` holds the language found.

    A text is rejected if it is null or has no letters, if its language is another, or if it needs more than ``max_cost`` bits a byte even there.
    Where nothing is labelled there is no language to tell: rows with letters stay as they are.
    """
    samples = labelled_samples(docs, id_col, text_col, lang_col)
    place = docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            if not samples:
                yield batch.filter(pa.array([bool(len(normalise(t))) for t in texts], pa.bool_()))
                continue
            langs, _, bits = classify_in_chunks(texts, samples)
            named = batch.set_column(place, batch.schema.field(place), pa.array(langs, batch.schema.field(place).type))
            yield named.filter(pa.array([x != UNKNOWN and (languages is None or x in languages) and b <= max_cost for x, b in zip(langs, bits, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    found = identify(docs, labelled_samples(docs, "doc_id", "text", "lang"))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
