"""BPE encoding by backtracking over longest token matches, decoding by an offset table.

The encoder of a word: an Aho-Corasick automaton over all tokens gives the longest token at every
place; tokens are laid from the left, each time the longest one that is compatible with its left
neighbour, else the next shorter token that starts there, and where none is left the last token is taken
back and the place marked as a dead end (so every place fails at most once: linear time). Two tokens are
compatible when merging their joined symbols by rank gives these two tokens again; a sequence whose
neighbours are all compatible is the one that the merges give. The answers are kept in a pair table.

Words of a text come from the tokenizer file's normaliser and splitting rules; encodings of words are
kept in a bounded dictionary per Python worker.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm.common import ship, table

#: words whose encodings a worker keeps in each of two generations; of the older one only what is used again stays
CACHE_WORDS = 120_000
#: pairs of tokens whose compatibility a worker keeps
PAIRS = 200_000
#: tokens decoded at a time
DECODE_CHUNK = 1 << 16
_NEVER = 1 << 60


def byte_symbols() -> list[str]:
    """The visible character that stands for each byte: printable Latin-1 characters for themselves, the
    others, in order, from code point 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Merges:
    """Tables of a BPE vocabulary; tokens are strings of symbols, a symbol being one character.

    Inside, tokens are their ids; a token has its length, the merge that makes it (rank, left, right) and
    the next shorter token that is a prefix of it."""

    def __init__(self, ids: dict[str, int], merges: list[tuple[str, str]]):
        import ahocorasick
        self.span = max(ids.values()) + 1
        self.rank = {ids[a] * self.span + ids[b]: r for r, (a, b) in enumerate(merges)}
        self.made = {ids[a + b]: (r, ids[a], ids[b]) for r, (a, b) in reversed(list(enumerate(merges)))}
        # tokens that merging their own symbols gives: base symbols, and merges whose border nothing crosses before
        whole: dict[int, bool] = {i: True for t, i in ids.items() if len(t) == 1}
        for a, b in merges:
            made = ids[a + b]
            r, left, right = self.made[made]
            whole[made] = whole.get(left, False) and whole.get(right, False) and self._uncrossed(left, right, r, r)
        usable = {t: i for t, i in ids.items() if whole.get(i)}
        self.matches = ahocorasick.Automaton()
        self.length = [0] * self.span
        self.shorter = [-1] * self.span
        for token, i in usable.items():
            self.matches.add_word(token, i)
            self.length[i] = len(token)
            self.shorter[i] = next((usable[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in usable), -1)
        self.matches.make_automaton()
        self.pairs: dict[int, bool] = {}

    def _uncrossed(self, x: int, y: int, x_ends: int = _NEVER, y_ends: int = _NEVER) -> bool:
        """True if no merge crosses the border between two tokens while they are built (or until the ranks
        given, at which they are taken in themselves).

        Pieces next to the border grow by rank: the piece on the left is part of its token from the merge
        that makes it until the merge that takes it in, likewise on the right. A merge of the two pieces
        happens if it comes before both are taken in; of equal ranks the one further left comes first."""
        while True:
            r = self.rank.get(x * self.span + y)
            if r is not None and r < x_ends and r <= y_ends:
                return False
            mx, my = self.made.get(x), self.made.get(y)
            if mx is None and my is None:
                return True
            if my is None or mx is not None and mx[0] > my[0]:
                x_ends, x = mx[0], mx[2]
            else:
                y_ends, y = my[0], my[1]

    def encode(self, word: str) -> list[int]:
        """Token ids of a word of symbols that are all tokens."""
        n = len(word)
        length, shorter, pairs, span = self.length, self.shorter, self.pairs, self.span
        if len(pairs) > PAIRS:
            pairs.clear()
        longest = [-1] * n
        for end, token in self.matches.iter(word):  # later ends are longer
            longest[end + 1 - length[token]] = token
        alive = bytearray(b"\x01") * (n + 1)
        laid: list[int] = []
        at, last = 0, -1
        token = longest[0] if n else -1
        while at < n:
            while token >= 0:
                if alive[at + length[token]]:
                    if last < 0:
                        break
                    key = last * span + token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self._uncrossed(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                laid.append(token)
                at += length[token]
                last = token
                if at < n:
                    token = longest[at]
            else:
                alive[at] = 0
                token = laid.pop()
                at -= length[token]
                last = laid[-1] if laid else -1
        return laid


class Encoder:
    """A tokenizer file with NFC, white space collapse and lower case as normaliser, words split by the
    letters/digit/other rule, and a suffix that marks the last symbol of a word."""

    #: texts of these characters only: normalisation is lower(), the split is a plain pattern
    _UNSAFE = re.compile("[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ÿ]")
    _SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.suffix = spec["model"]["end_of_word_suffix"]
        symbols = byte_symbols()
        self.byte = {c: b for b, c in enumerate(symbols)}
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = Merges({self._inner(t): i for t, i in vocab.items()},
                             [(self._inner(a), self._inner(b)) for a, b in pairs])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        own = Tokenizer.from_file(path)
        self.normalize, self.pretokenize = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _inner(self, token: str) -> str:
        """Token as symbols: a character per byte, 256 more for a last one."""
        last = token.endswith(self.suffix)
        s = "".join(chr(self.byte[c]) for c in (token[:-len(self.suffix)] if last else token))
        return s[:-1] + chr(ord(s[-1]) + 256) if last else s

    def _word(self, data: bytes) -> bytes:
        s = data.decode("latin-1")
        return array("i", self.merges.encode(s[:-1] + chr(ord(s[-1]) + 256))).tobytes()

    def _segment(self, text: str) -> Iterator[bytes]:
        if self._UNSAFE.search(text) is None:
            words = self._SPLIT.findall(text.lower())
        else:
            words = [bytes(map(self.byte.__getitem__, w)).decode("utf-8", "surrogateescape")
                     for w, _ in self.pretokenize(self.normalize(text))]
        if len(self.words) > CACHE_WORDS:
            self.older, self.words = self.words, {}
        known, older = self.words, self.older
        for w in set(words).difference(known):
            known[w] = older.get(w) or self._word(w.encode("utf-8", "surrogateescape"))
        return map(known.__getitem__, words)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers."""
        if "<|" not in text:
            return b"".join(self._segment(text))
        parts = []
        for p in self.cut.split(text):
            if p in self.added:
                parts.append(np.array([self.added[p]], dtype="<i4").tobytes())
            elif p:
                parts.extend(self._segment(p))
        return b"".join(parts)


class Decoder:
    """All tokens, each after a blank, in one block of bytes, and where each begins."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        blocks = [(" " + names[i]).encode() if i in names else b"" for i in range(max(names) + 1)]
        self.offset = np.concatenate([[0], np.cumsum([len(b) for b in blocks])])
        self.block = np.frombuffer(b"".join(blocks), dtype=np.uint8)

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by blanks, special tokens included; ids the table lacks are left out."""
        out = []
        ids = ids[(ids >= 0) & (ids < len(self.offset) - 1)]
        for k in range(0, len(ids), DECODE_CHUNK):
            part = ids[k:k + DECODE_CHUNK]
            start, length = self.offset[part], self.offset[part + 1] - self.offset[part]
            ends = np.cumsum(length)
            places = np.arange(ends[-1]) + np.repeat(start - (ends - length), length)
            out.append(self.block[places].tobytes())
        return b"".join(out)[1:].decode()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_DECODERS: dict[str, Decoder] = {}


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(path)
    return _DECODERS[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with its text column replaced by ``ids_col``, the token ids of the whole text.

    Null texts are empty and have no ids. Other columns pass through; one named ``ids_col`` is replaced.
    A long text needs memory for itself and its ids; other texts of its batch are done one by one."""
    ship(docs.sparkSession)
    rest = [c for c in docs.columns if c not in (text_col, ids_col)]

    def run(batches):
        own = encoder(path)
        for b in batches:
            ids = [own.encode(t.as_py() or "") for t in b.column(b.num_columns - 1)]
            ends = np.cumsum([0] + [len(x) // 4 for x in ids])
            if ends[-1] >= 1 << 31:
                raise ValueError("a batch has too many ids; lower spark.sql.execution.arrow.maxRecordsPerBatch")
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), dtype="<i4")))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lists], names=[*rest, ids_col])
    kept = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text_col}`").cast("string").alias(text_col))
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest]
    return kept.mapInArrow(run, ", ".join([*fields, f"`{ids_col}` array<int>"]))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``tokens`` with a column ``text_col`` of the decoded ids (replacing one of that name); null ids: empty."""
    ship(tokens.sparkSession)
    rest = [c for c in tokens.columns if c != text_col]
    at = rest.index(ids_col)

    def run(batches):
        own = decoder(path)
        for b in batches:
            lists = b.column(at)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            texts = [own.decode(flat[i:j]) if ok else "" for i, j, ok in zip(ends[:-1], ends[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*rest, text_col])
    fields = [f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in rest]
    return tokens.select(*[F.col(f"`{c}`") for c in rest]).mapInArrow(run, ", ".join([*fields, f"`{text_col}` string"]))


def word_bpe_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------------------ query
def op4_bpe(spark, sf_dir):
    """Ids of every document and the text they decode to, as digests."""
    path = word_bpe_path()
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return decode(ids, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
