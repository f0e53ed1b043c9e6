"""SimHash near-duplicates over an anchor-point covering of the 64-bit space.

Each 64-bit fingerprint is cut into two halves of 32 bits. If two fingerprints differ in at most
three bits, one of the halves differs in at most one. In each half the anchors are the words of a
covering code: the perfect Hamming [31,26] code (covering radius one) times the free last bit. Every
half-word lies within distance one of exactly one anchor with its free bit, its home. A fingerprint is
replicated to every anchor within covering radius plus threshold (1 + 1) of its half: those are the
homes of all half-words that differ from it in one bit. Fingerprints are compared per anchor, home
copies against replicated copies, by their full 64-bit distance.

A half-word has at most 17 anchors within distance two, so the replication is at most 34 rows per
distinct fingerprint, and there are 2**27 anchors per half: the groups stay small as the input grows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import cut, ship, table
from venue_analytics.llm.components import connected_components

#: Shingles hashed at a time: bounds the memory a very long text takes.
CHUNK = 1 << 15
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_UPPER = {c: c + 32 for c in range(65, 91)}


def _shingles(text: str, size: int) -> Iterator[str]:
    """Windows of ``size`` words, one by one; the whole sequence when there are fewer words."""
    window: list[str] = []
    whole = False
    for m in _WORD.finditer(text):
        window.append(m.group())
        if len(window) == size:
            whole = True
            yield " ".join(window)
            del window[0]
    if window and not whole:
        yield " ".join(window)


def simhash64(text: str | None, size: int) -> int:
    """Signed 64-bit fingerprint: a bit is one if set in over half of the XXH64 (seed 42) of the shingles.

    Null, empty and white texts give zero."""
    from xxhash import xxh64_intdigest
    text = (text or "").translate(_UPPER)
    total, n = np.zeros(64, dtype=np.int64), 0
    if len(text) <= CHUNK:
        words = _WORD.findall(text)
        parts = [words] if len(words) < size else [words[i:len(words) - size + 1 + i] for i in range(size)]
        grams = [" ".join(words)] if words and len(words) < size else map(" ".join, zip(*parts)) if words else ()
        chunks = iter([list(grams)])
    else:
        source = _shingles(text, size)
        chunks = iter(lambda: [g for _, g in zip(range(CHUNK), source)], [])
    for chunk in chunks:
        if chunk:
            h = np.array([xxh64_intdigest(g, 42) for g in chunk], dtype="<u8")
            total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(chunk)
    bits = np.packbits((2 * total > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, fp)`` of every row of ``docs``; ``fp`` is a signed long, ``id`` keeps its type."""
    def run(batches):
        for b in batches:
            fps = [simhash64(t.as_py(), size) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fp bigint")


def _syndrome(half: Column) -> Column:
    """Syndrome of the lower 31 bits under the Hamming code whose check columns are 1 to 31."""
    s = F.lit(0)
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
        s = s + F.pmod(F.bit_count(half.bitwiseAND(F.lit(mask).cast("long"))), F.lit(2)) * (1 << k)
    return s


def _flip(half: Column, place: Column) -> Column:
    """``half`` with the bit of check column ``place`` (1 to 31) inverted; as it is for place zero."""
    return F.when(place == 0, half).otherwise(half.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))))


def home_and_cover(half: Column, syn: Column) -> tuple[Column, Column]:
    """The anchor within covering radius of a half-word, and all anchors within distance two of it.

    With a syndrome ``s`` other than zero the code words at distance two are reached by inverting the
    pairs of places ``i`` and ``i xor s``; the free bit inverted costs one more than the home."""
    home = _flip(half, syn)
    free = home.bitwiseXOR(F.lit(1 << 31).cast("long"))
    places = F.filter(F.sequence(F.lit(1), F.lit(31)),
                      lambda i: (i.bitwiseXOR(syn) > i))
    two = F.transform(places, lambda i: _flip(_flip(half, i), i.bitwiseXOR(syn)))
    return home, F.when(syn == 0, F.array(home, free)).otherwise(F.concat(F.array(home, free), two))


def links(fps: DataFrame, distance: int = 3) -> DataFrame:
    """``(u, v)`` of the distinct fingerprints ``fps(fp)`` that differ in at most ``distance`` (<= 3) bits.

    A pair may come once from each half; u < v. Works for up to three bits, as two halves then
    guarantee one with at most one."""
    if not 0 <= distance <= 3:
        raise ValueError("the covering is laid out for at most 3 bits")
    low = F.lit(0xFFFFFFFF).cast("long")
    halves = (fps.select("fp", F.explode(F.array(
        F.struct(F.lit(0).cast("byte").alias("side"), F.col("fp").bitwiseAND(low).alias("half")),
        F.struct(F.lit(1).cast("byte").alias("side"), F.shiftrightunsigned("fp", 32).alias("half")))).alias("h"))
        .select("fp", "h.side", "h.half").withColumn("syn", _syndrome(F.col("half"))))
    home, cover = home_and_cover(F.col("half"), F.col("syn"))
    homes = halves.select("side", home.alias("anchor"), F.col("fp").alias("u"))
    covers = halves.select("side", F.explode(cover).alias("anchor"), F.col("fp").alias("v"))
    return (homes.join(covers, ["side", "anchor"])
            .where((F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance))
            .select("u", "v"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3,
                   distance: int = 3) -> DataFrame:
    """``(id, fp, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``distance`` bits. Equal
    fingerprints are one class (so exact copies never meet pairwise); null or empty texts have
    fingerprint zero and link like any other. Ids may repeat (each row is a row of its own) or be null
    (ignored in the smallest id; null if a component has no other)."""
    rows = cut(fingerprints(docs, id_col, text_col, size))
    classes = rows.groupBy("fp").agg(F.min("id").alias("low"))
    roots = connected_components(links(classes.select("fp"), distance))
    known = cut(classes.join(roots, classes["fp"] == roots["node"], "left")
                .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    # apart from the join, which can then split a large component's partition
    lows = cut(known.groupBy("root").agg(F.min("low").alias("component_id")))
    return rows.join(known.join(lows, "root").select("fp", "component_id"), "fp").select("id", "fp", "component_id")


# ------------------------------------------------------------------------------ query
def op7_simhash(spark, sf_dir):
    """SimHash groups of all documents: 3-word shingles, links at three bits or fewer."""
    got = simhash_groups(table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id")
