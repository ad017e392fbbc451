"""BPE encoding and decoding with a pair occurrence index.

A block of a partition is tokenized at once. Its distinct pieces are laid out in one
symbol array; an index maps every mergeable pair to all positions where it occurs; the
pair ranks that are active are applied in ascending order, each to its whole list of
positions, and the lists of the neighbouring pairs get the new positions. Encoded words
and merged pieces are kept per worker in bounded tables, so a word that returns is not encoded again, nor
a piece merged again that returns in another spelling or with other marks around it.

Texts are whole, in any language. Null texts are empty, empty texts have no ids. Rows
with equal ids or texts are encoded each on their own; extra columns are not read.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import ship, small_slices, table, text_bytes

BLOCK_BYTES = 4 << 20           # text that is split and looked up at once
INDEX_WORDS = 40_000            # new words that share one pair index
KEPT_WORDS = 450_000            # words kept per worker; beyond, those that the last block didn't use go
KEPT_PIECES = 150_000           # merged pieces of new words kept per worker, and as many of the words before them
TOKENIZER = "word_bpe_49k.json"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next free code from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def plain_cutter(spec: dict):
    """The pre-tokenizer as a function on lower-case printable ASCII, where NFC and the byte alphabet change nothing;
    None if the file asks for anything else than NFC, white space, lower case, and a split into the matches of a pattern."""
    normal = spec.get("normalizer") or {}
    steps = [n["type"] for n in normal.get("normalizers", [normal])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or normal["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, level = cuts
    if split["behavior"] != "Removed" or not split["invert"] or level["use_regex"] or level["add_prefix_space"]:
        return None
    return regex.compile(split["pattern"]["Regex"]).findall


class PairIndexCodec:
    """Encoder and decoder for a BPE tokenizer file (JSON of the ``tokenizers`` library, byte-level pieces)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("post_processor") or spec.get("decoder"):
            raise ValueError("only plain BPE files without post-processor and decoder are supported")
        vocab: dict[str, int] = model["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.normal = lib.normalizer.normalize_str if lib.normalizer else str
        self.cut = lib.pre_tokenizer.pre_tokenize_str
        self.plain = plain_cutter(spec)
        self.added = added
        self.added_cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.tokens: list[str | None] = [None] * (max([*vocab.values(), *added.values()]) + 1)
        for text, i in [*vocab.items(), *added.items()]:
            self.tokens[i] = text
        end = model.get("end_of_word_suffix") or ""
        self.inner = {c: vocab[c] for c in byte_alphabet() if c in vocab}
        self.last = {c: vocab[c + end] for c in byte_alphabet() if c + end in vocab}
        self.merges: list[tuple[int, int, int]] = []
        self.ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate(tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]):
            self.merges.append((vocab[a], vocab[b], vocab[a + b]))
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
        first_use: dict[int, int] = {}
        for rank, (a, b, _) in enumerate(self.merges):
            first_use.setdefault(a, rank)
            first_use.setdefault(b, rank)
        if any(first_use.get(new, rank + 1) <= rank for rank, (_, _, new) in enumerate(self.merges)):
            raise ValueError("a merge uses a token before it can exist: ranks can't be applied in one ascending pass")
        self.known: dict[bytes, bytes] = {}
        self.young: dict[str, bytes] = {}       # merged pieces: of the last words, and of those before them
        self.aged: dict[str, bytes] = {}

    def merge(self, pieces: list[str]) -> list[list[int]]:
        """Token ids of each piece (characters of the byte alphabet)."""
        sym, after, before = array("i"), array("i"), array("i")
        starts: list[int] = []
        ranks, merges = self.ranks, self.merges
        inner, last = self.inner, self.last
        for piece in pieces:
            begin = len(sym)
            starts.append(begin)
            sym.extend([inner[c] for c in piece[:-1] if c in inner])
            if piece and piece[-1] in last:
                sym.append(last[piece[-1]])
            n = len(sym)
            after.extend(range(begin + 1, n + 1))
            before.extend(range(begin - 1, n - 1))
            if n > begin:
                after[-1] = before[begin] = -1
        starts.append(len(sym))
        places: dict[int, list[int]] = {}
        for i, j in enumerate(after):
            if j >= 0 and (rank := ranks.get(sym[i] << 32 | sym[j])) is not None:
                if rank in places:
                    places[rank].append(i)
                else:
                    places[rank] = [i]
        active = list(places)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            a, b, new = merges[rank]
            for i in sorted(places.pop(rank)):
                j = after[i]
                if sym[i] != a or j < 0 or sym[j] != b:
                    continue            # a lower rank or a neighbour on the left has taken it
                sym[i], sym[j] = new, -1
                k = after[i] = after[j]
                h = before[i]
                if k >= 0:
                    before[k] = i
                    if (r := ranks.get(new << 32 | sym[k])) is not None:
                        if r in places:
                            places[r].append(i)
                        else:
                            places[r] = [i]
                            heapq.heappush(active, r)
                if h >= 0 and (r := ranks.get(sym[h] << 32 | new)) is not None:
                    if r in places:
                        places[r].append(h)
                    else:
                        places[r] = [h]
                        heapq.heappush(active, r)
        return [[s for s in sym[i:j] if s >= 0] for i, j in zip(starts, starts[1:], strict=False)]

    def learn(self, words: list[bytes]) -> None:
        """Encode words (no ASCII white space inside) that are not known yet; pieces that no earlier word had are merged in one pair index."""
        if len(self.young) > KEPT_PIECES:
            self.aged, self.young = self.young, {}
        young, aged = self.young, self.aged
        parts: list[list[bytes | str]] = []
        fresh: dict[str, None] = {}
        for word in words:
            own: list[bytes | str] = []
            text = word.decode("utf-8")
            for part in self.added_cut.split(text) if self.added_cut and "<" in text else (text,):
                if part in self.added:
                    own.append(array("I", [self.added[part]]).tobytes())
                elif part:
                    if self.plain and part.isascii() and part.isprintable():
                        found = self.plain(part.lower())
                    else:
                        found = [piece for piece, _ in self.cut(self.normal(part))]
                    for piece in found:
                        if piece not in young:
                            if piece in aged:
                                young[piece] = aged[piece]
                            else:
                                fresh[piece] = None
                    own += found
            parts.append(own)
        for piece, ids in zip(fresh, self.merge(list(fresh)), strict=True):
            young[piece] = array("I", ids).tobytes()
        for word, own in zip(words, parts, strict=True):
            ids = [young[x] if isinstance(x, str) else x for x in own]
            self.known[word] = ids[0] if len(ids) == 1 else b"".join(ids)

    def encode_block(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [t.split() if t else [] for t in texts]
        seen: set[bytes] = set()
        for w in split:
            seen.update(w)
        new = sorted(seen.difference(self.known), key=bytes.lower)      # spellings of a word side by side share its piece
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known = {w: self.known[w] for w in seen.intersection(self.known)}
        for start in range(0, len(new), INDEX_WORDS):
            self.learn(new[start:start + INDEX_WORDS])
        get = self.known.__getitem__
        return [b"".join(map(get, w)) for w in split]

    def decode(self, ids: bytes) -> str:
        """Text of the ids: their tokens with a space between; ids without a token are left out."""
        tokens = self.tokens
        try:
            return " ".join(map(tokens.__getitem__, memoryview(ids).cast("I")))
        except (IndexError, TypeError):
            return " ".join(t for i in array("I", ids) if i < len(tokens) and (t := tokens[i]) is not None)


@functools.lru_cache(maxsize=2)
def codec(path: str) -> PairIndexCodec:
    return PairIndexCodec(path)


def bpe_encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id_col``, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers) of every row."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in small_slices(batches, "text", BLOCK_BYTES):
            ids = own.encode_block(text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[id_col, "n_tokens", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids binary")


def bpe_decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``df`` but ``ids_col``, which gives way to the decoded text; null ids give an empty text."""
    ship(df.sparkSession)
    rest = [c for c in df.columns if c != ids_col]
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in small_slices(batches, ids_col, BLOCK_BYTES):
            texts = [own.decode(x or b"") for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(texts, pa.string())],
                                             names=[*rest, out_col])

    return df.select(*rest, ids_col).mapInArrow(run, f"{kinds}, `{out_col}` string")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    coded = bpe_encode(docs, path)
    coded = coded.withColumn("ids_sha256", F.sha2("ids", 256))
    return bpe_decode(coded, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path())
