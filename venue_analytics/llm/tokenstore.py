"""Token ids in binary files, compressed by Re-Pair grammars.

Documents are dealt into ranges of ascending id and sorted; each range writes its ids as shards. A shard
holds whole documents, about ``SHARD`` ids. Within it frequent pairs of neighbouring ids are replaced by
nonterminals, again and again; a pair never spans two documents, so any document can be expanded alone.
A shard's row of the Parquet file has the documents' ids, their token counts, where each begins in the
symbol sequence, the symbols, and the grammar: the pair of each rule and the length of its expansion.
Files are written by Spark's committed writer, so a lost task is written again whole.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from venue_analytics.llm.bpe import byte_symbols
from venue_analytics.llm.common import cut, ship, small, table
from venue_analytics.session import checkpoint_dir

#: ids per shard, about: a shard ends with the document that reaches it
SHARD = 1 << 20
#: occurrences a pair needs; rounds go on until no pair has them
OFTEN = 24
#: pieces whose ids a worker keeps in each of two generations
CACHE_PIECES = 600_000
_HASH_BITS, _SYMBOL_BITS = 18, 20
#: places up to which pairs are sorted rather than hashed
SORTED = 1 << 15


def symbol_kind(size: int) -> np.dtype:
    """Unsigned integers for symbols below ``size``."""
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


class Encoder:
    """A byte-level BPE file of the tokenizers library. Texts are cut by the library's own splitting rule, and
    the ids of each piece, which the library's model gives for the piece's byte symbols, are kept; texts with
    characters outside ASCII and Latin-1 letters go to the library whole."""

    _UNSAFE = re.compile("[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]")
    _SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\\s0-9A-Za-zÀ-ÖØ-öø-ÿ]+|\\s+(?!\\S)|\\s+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        self.size = self.own.get_vocab_size(with_added_tokens=True)
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]
        self.kind = symbol_kind(self.size)
        self.model = self.own.model
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.symbols = dict(enumerate(byte_symbols()))
        self.known, self.older = _Known(self._learn), {}

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def encode(self, text: str) -> bytes:
        if self._UNSAFE.search(text) is not None or any(s in text for s in self.special):
            return self._bytes(self.own.encode(text, add_special_tokens=False).ids)
        if len(self.known) > CACHE_PIECES:
            self.older, self.known = self.known, _Known(self._learn)
        return b"".join(map(self.known.__getitem__, self._SPLIT.findall(text)))

    def _learn(self, piece: str) -> bytes:
        """Ids of a piece not in the younger generation: from the older one, else from the library's model."""
        got = self.older.get(piece)
        if got is None:
            # printable ASCII stands for itself but for the blank
            word = (piece.replace(" ", self.symbols[32]) if piece.isascii() and piece.isprintable()
                    else piece.encode().decode("latin-1").translate(self.symbols))
            got = array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()
        return got


class _Known(dict):
    """A dictionary that learns what it lacks."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, piece: str) -> bytes:
        got = self[piece] = self.learn(piece)
        return got


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _frequent(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that occur OFTEN times in ``key``: ``(pairs by falling count, places of theirs, pair of each place)``.

    Counted in a hash table; of the pairs that share a slot one is counted exactly, the others again with
    another hash, and what is left at last is sorted."""
    place = np.arange(len(key))
    pairs, counts, places, which = [], [], [], []
    made = 0
    for turn in range(4):
        if len(key) < SORTED:
            break
        factor = np.int64(-7046029254386353131 + (turn * 0x5851F42D4C957F2E & (1 << 62) - 1))
        slot = ((key * factor).view(np.uint64) >> np.uint64(64 - _HASH_BITS)).astype(np.int32)
        here = np.flatnonzero((np.bincount(slot, minlength=1 << _HASH_BITS) >= OFTEN)[slot])
        key, slot, place = key[here], slot[here], place[here]
        pair = np.empty(1 << _HASH_BITS, dtype=np.int64)
        pair[slot] = key
        one = pair[slot] == key
        count = np.bincount(slot[one], minlength=1 << _HASH_BITS)
        often = np.flatnonzero(count >= OFTEN)
        rank = np.full(1 << _HASH_BITS, -1, dtype=np.int32)
        rank[often] = np.arange(made, made + len(often), dtype=np.int32)
        new = rank[slot[one]]
        pairs.append(pair[often])
        counts.append(count[often])
        places.append(place[one][new >= 0])
        which.append(new[new >= 0])
        made += len(often)
        key, place = key[~one], place[~one]
    if len(key):
        found, back, count = np.unique(key, return_inverse=True, return_counts=True)
        often = np.flatnonzero(count >= OFTEN)
        rank = np.full(len(found), -1, dtype=np.int32)
        rank[often] = np.arange(made, made + len(often), dtype=np.int32)
        new = rank[back]
        pairs.append(found[often])
        counts.append(count[often])
        places.append(place[new >= 0])
        which.append(new[new >= 0])
    if not pairs:
        return np.zeros(0, dtype=np.int64), place[:0], np.zeros(0, dtype=np.int32)
    pair, count, at, new = (np.concatenate(x) for x in (pairs, counts, places, which))
    order = np.lexsort((pair, -count))
    back = np.empty(len(order), dtype=np.int32)
    back[order] = np.arange(len(order), dtype=np.int32)
    by = np.argsort(at, kind="stable")
    return pair[order], at[by], back[new[by]]


def compress(ids: np.ndarray, begins: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(symbols, begins, rules)`` of a shard: ids below ``size``, nonterminal ``size + k`` for rule ``k``.

    ``begins`` are the places where documents begin, in ids and then in symbols. A round counts pairs,
    makes all that occur ``OFTEN`` times rules and replaces their occurrences from left to right; those that
    overlap a replaced one are gone. Only pairs with a symbol that the round before made can have become
    frequent, so the first round counts all pairs and the others count beside the last replacements alone.
    Ends when no pair within a document occurs ``OFTEN`` times. Rules that nothing uses, or only one
    symbol, are undone. Symbols have 20 bits; a larger vocabulary is an error, and no rule goes beyond."""
    if size > 1 << _SYMBOL_BITS:
        raise ValueError(f"symbols have {_SYMBOL_BITS} bits; the vocabulary has {size}")
    seq, rules, made = ids.astype(np.int32), [], size
    begins = np.asarray(begins, dtype=np.int64)
    fresh = 0  # first symbol of the round before
    while len(seq) >= 2 and made < 1 << _SYMBOL_BITS:
        inside = (seq[:-1] >= fresh) | (seq[1:] >= fresh)
        inside[begins[1:] - 1] = False  # pairs that span two documents
        here = np.flatnonzero(inside)
        key = seq[here].astype(np.int64)
        key <<= _SYMBOL_BITS
        key |= seq[here + 1]
        pairs, at, new = _frequent(key)
        if len(pairs) == 0:
            break
        most = (1 << _SYMBOL_BITS) - made
        fresh = made
        pairs, at, new = pairs[:most], here[at[new < most]], new[new < most]
        order = np.arange(len(at))
        start = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, order, 0))
        stays = (order - start) % 2 == 0
        at, new = at[stays], new[stays]
        used = np.bincount(new, minlength=len(pairs)) > 0
        number = (made + np.cumsum(used) - 1).astype(np.int32)
        seq[at] = number[new]
        keep = np.ones(len(seq), dtype=bool)
        keep[at + 1] = False
        begins = begins - np.searchsorted(at, begins)
        seq = seq[keep]
        pairs = pairs[used]
        rules.append(np.stack([pairs >> _SYMBOL_BITS, pairs & ((1 << _SYMBOL_BITS) - 1)], axis=1))
        made += len(pairs)
    return _pruned(seq, begins, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64), size)


def _pruned(seq: np.ndarray, begins: np.ndarray, rules: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same without rules that nothing uses, or that the symbols use once and no rule does."""
    while len(rules):
        in_seq = np.bincount(seq[seq >= size] - size, minlength=len(rules))
        in_rules = np.bincount(rules[rules >= size] - size, minlength=len(rules))
        gone = (in_seq <= 1) & (in_rules == 0)
        if not gone.any():
            break
        big = seq >= size
        big[big] = gone[seq[big] - size]
        at = np.cumsum(1 + big) - 1  # the last place of each symbol's expansion
        out = np.empty(at[-1] + 1, dtype=seq.dtype)
        out[at[~big]] = seq[~big]
        pairs = rules[seq[big] - size]
        out[at[big] - 1], out[at[big]] = pairs[:, 0], pairs[:, 1]
        begins = begins + np.concatenate([[0], np.cumsum(big)])[begins]
        number = np.concatenate([np.arange(size), size + np.cumsum(~gone) - 1])
        seq, rules = number[out].astype(np.int32), number[rules[~gone]]
    return seq, begins, rules


def expansion_lengths(rules: np.ndarray, size: int) -> np.ndarray:
    """Ids that each rule stands for; a rule's symbols are ids or earlier rules."""
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((lengths[a - size] if a >= size else 1) + (lengths[b - size] if b >= size else 1))
    return np.array(lengths, dtype=np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, size: int) -> np.ndarray:
    """Ids of a stretch of symbols."""
    seq = symbols.astype(np.int64)
    while len(rules) and (big := seq >= size).any():
        at = np.cumsum(1 + big) - 1
        out = np.empty(at[-1] + 1, dtype=np.int64)
        out[at[~big]] = seq[~big]
        pairs = rules[seq[big] - size]
        out[at[big] - 1], out[at[big]] = pairs[:, 0], pairs[:, 1]
        seq = out
    return seq


class Grammar:
    """Expansions of all rules in one table, to expand many symbols by one gather."""

    def __init__(self, rules: np.ndarray, lengths: np.ndarray, size: int):
        self.size = size
        self.length = np.concatenate([np.ones(size, dtype=np.int64), lengths])
        self.start = np.concatenate([np.arange(size), size + np.cumsum(lengths) - lengths])
        self.ids = np.concatenate([np.arange(size), expand(np.arange(size, size + len(rules)), rules, size)])

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        length = self.length[symbols]
        ends = np.cumsum(length)
        if len(ends) == 0:
            return ends
        return self.ids[np.arange(ends[-1]) + np.repeat(self.start[symbols] - (ends - length), length)]


def write_shards(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, parts: int | None = None) -> None:
    """Write the ids of all texts, each followed by ``end_id``, to Parquet files at ``path``.

    Documents ascend by id (null first), equal ids by text. Null texts are empty: the end id alone.
    ``parts`` ranges are written at a time (default: the session's shuffle partitions)."""
    ship(docs.sparkSession)
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = own._bytes([end_id])
        held, names, n, shard, first = [], [], 0, 0, 0
        arrow = None

        def row():
            data = b"".join(held)
            ids = np.frombuffer(data, dtype=own.kind)
            counts = np.array([len(x) for x in held], dtype=np.int64) // own.kind.itemsize
            symbols, begins, rules = compress(ids, np.cumsum(counts) - counts, own.size)
            lengths = expansion_lengths(rules, own.size)
            one = [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()),
                   pa.ListArray.from_arrays([0, len(names)], pa.concat_arrays(names) if names else pa.array([], arrow)),
                   pa.array([counts]), pa.array([begins]), pa.array([symbols.astype(symbol_kind(own.size + len(rules))).tobytes()], pa.binary()),
                   pa.array([rules.astype("<u4").tobytes()], pa.binary()), pa.array([lengths.astype("<u4").tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(one, names=_NAMES)
        for b in batches:
            arrow = b.schema.field(0).type
            for k, text in enumerate(b.column(1)):
                data = own.encode(text.as_py() or "") + end
                held.append(data)
                names.append(b.column(0).slice(k, 1))
                n += len(data) // own.kind.itemsize
                if n >= SHARD:
                    yield row()
                    shard, first = shard + 1, first + n
                    held, names, n = [], [], 0
        if held:
            yield row()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = (rows.repartitionByRange(parts, F.col("id").asc_nulls_first(), F.xxhash64("text"))
             .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text"))
    dealt.mapInArrow(run, _SCHEMA.replace("KIND", kind)).write.parquet(path)


_SCHEMA = ("part int, shard int, first bigint, n bigint, ids array<KIND>, counts array<bigint>, begins array<bigint>, "
           "symbols binary, rules binary, lengths binary")
_NAMES = [f.split()[0] for f in _SCHEMA.split(", ")]


def read_shards(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """Per document of the files at ``path``: ``(id, start, n_tokens, ids_crc32)``; ids as little-endian
    unsigned 32-bit integers. ``start`` counts the ids of all documents before it."""
    ship(spark)
    shards = spark.read.parquet(path)
    kind = shards.schema["ids"].dataType.elementType.simpleString()
    totals = shards.groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per written range
    offsets = small(cut(totals.select("part", F.coalesce(before, F.lit(0)).alias("offset"))), 100_000)

    def run(batches):
        own = encoder(tokenizer)
        for b in batches:
            for k in range(b.num_rows):
                symbols, rules, lengths = _shard(b, k, own)
                ids = Grammar(rules, lengths, own.size).expand(symbols).astype("<u4")
                counts = b.column(4)[k].values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(counts)
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * (e - c):4 * e]) for c, e in zip(counts.tolist(), ends.tolist())]
                first = b.column(2)[k].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(1)[k].as_py(), len(counts)), pa.int32()), b.column(3)[k].values,
                                                  pa.array(first + ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                                                 names=["part", "id", "at", "n_tokens", "ids_crc32"])

    def _shard(b, k, own):
        take = lambda c, t: np.frombuffer(b.column(c)[k].as_buffer(), dtype=t)
        rules = take(6, "<u4").reshape(-1, 2).astype(np.int64)
        return take(5, symbol_kind(own.size + len(rules))), rules, take(7, "<u4").astype(np.int64)
    given = shards.select("shard", "part", "first", "ids", "counts", "symbols", "rules", "lengths")
    docs = given.mapInArrow(run, f"part int, id {kind}, at bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(offsets, "part").select("id", (F.col("at") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def read_document(spark: SparkSession, path: str, tokenizer: str, doc_id) -> list[list[int]]:
    """Ids of the documents with this id, each expanded from its own symbols only."""
    own, found = encoder(tokenizer), []
    for r in spark.read.parquet(path).where(F.array_contains("ids", doc_id)).orderBy("part", "shard").collect():
        rules = np.frombuffer(r["rules"], dtype="<u4").reshape(-1, 2).astype(np.int64)
        symbols = np.frombuffer(r["symbols"], dtype=symbol_kind(own.size + len(rules)))
        ends = [*r["begins"][1:], len(symbols)]
        found += [expand(symbols[a:b], rules, own.size).tolist() for x, a, b in zip(r["ids"], r["begins"], ends) if x == doc_id]
    return found


def byte_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------------------ query
def op8_tokens(spark, sf_dir):
    """Ids of all documents written to files in the shared folder, and read back from them."""
    folder = checkpoint_dir(spark)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{folder}/token-files-{uuid.uuid4().hex}"
    write_shards(table(spark, sf_dir, "documents"), path, byte_bpe_path())
    got = cut(read_shards(spark, path, byte_bpe_path()))
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return got.withColumnRenamed("id", "doc_id")
