"""Token-ID output: documents to ids, ids to Huffman-coded files in the order of doc_id, and back.

Whole texts are encoded once into a table of ids. Global counts of ids (a table no longer than the vocabulary) give one
code for all files. The ids are dealt by ranges of doc_id and each range becomes a file of self-contained segments, so
memory is bounded by a segment whatever the range holds. File: MAGIC, then the code lengths (deflated), then segments of
header, doc_ids, counts, block checkpoints, bits; integers are little-endian. A segment's first documents may have no id; the header says how many.

Defined cases: null text is empty, that is the end id alone; a null doc_id sorts first; repeated rows are written as
often as they occur; an empty table gives no files and an empty result.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanlink.llm import huffman
from spanlink.llm.common import beside, give_back, materialize, shared_dir, table
from spanlink.llm.files import reading, replacing
from spanlink.llm.toxicity import by_chars

MAGIC = b"SLHUF1\n"
END_ID = 2
#: Of a segment: documents, those without an id, ids, checkpoints, bytes of code, checksum.
_HEAD = struct.Struct("<IIQIQI")
#: Ids in a segment, about; a longer document is a segment of its own.
SEGMENT = 1 << 20
#: Ids in a file, about.
FILE_TOKENS = 8 << 20
#: Rows of a batch whose texts are held as Python strings at once.
BATCH_ROWS = 512
#: Characters of these handed to the tokenizer at once, or one longer text.
BATCH_CHARS = 1 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def packing(tokenizer_file: str, end_id: int = END_ID) -> str:
    """How ids lie in tables: unsigned little-endian integers of 16 bits if all fit, else of 32."""
    from tokenizers import Tokenizer

    size = Tokenizer.from_file(tokenizer_file).get_vocab_size()
    give_back()  # the driver asks this, and needs the tokenizer for nothing else
    return "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"


class Encoder:
    """Whole texts to ids.

    A byte-level BPE with the usual splitting rule never lets a token reach over white space that follows something visible, nor
    from a letter into a mark after it. Texts are cut at single white space, a batch's distinct pieces are looked up, and numpy
    lays their ids out in the order of the texts; a piece that ends in a mark is that of the letters plus that of the mark. Texts where
    a cut might not be one (runs of white space, control characters, markup of special tokens) and other kinds of tokenizer get the
    text encoded as it is.
    """

    #: Pieces that are remembered; later ones are encoded again for each batch.
    CACHE = 1_200_000
    #: Bytes of new pieces in one string for the tokenizer.
    JOINED = 1 << 14
    _whole = r"[\s\x0b\x{85}\pZ\x1c-\x1f]{2}|[\x00\x1c-\x1f]|<\|"

    def __init__(self, tokenizer_file: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.kind = Tokenizer.from_file(tokenizer_file), kind
        rules = json.loads(self.model.to_str())
        pre = rules.get("pre_tokenizer") or {}
        usual = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.by_piece = usual and rules.get("normalizer") is None and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in rules["added_tokens"])
        vocab = self.model.get_vocab(with_added_tokens=False)
        #: Bytes that a token stands for: its alphabet has one character for each.
        self.width = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        self.width[list(vocab.values())] = [len(t) for t in vocab]
        #: Of known piece k, the ids are ids[begin[k]:begin[k + 1]].
        self.known: dict[str, int] = {}
        self.ids, self.begin = np.zeros(0, kind), np.zeros(1, np.int64)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that each begin with white space and end in something visible, which may stand in one text therefore."""
        sizes = np.array([len(p.encode()) for p in pieces], np.int64)
        flat = np.array(self.model.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, self.kind)
        if len(flat) and flat.max() >= len(self.width):
            return self._encode(pieces)
        ends, want = np.cumsum(self.width[flat]), np.cumsum(sizes)
        to = np.searchsorted(ends, want)
        if to[-1] >= len(ends) or ends[-1] != want[-1] or (ends[to] != want).any():
            return self._encode(pieces)
        raw, cut, width = flat.tobytes(), (to + 1).tolist(), flat.itemsize
        return [raw[width * a : width * b] for a, b in zip([0, *cut[:-1]], cut, strict=True)]

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, in their order."""
        marked = [p.endswith((".", ",")) and p[-2:-1].isalpha() for p in pieces]
        plain = {p[:-1] if m else p for p, m in zip(pieces, marked, strict=True)}
        joined = [p for p in plain if p.startswith((" ", "\n")) and not p[-1].isspace()]
        alone = list(plain.difference(joined).union(".,"))
        fresh = dict(zip(alone, self._encode(alone), strict=True))
        for some in by_chars(joined, self.JOINED):
            fresh.update(zip(joined[some], self._encode_joined(joined[some]), strict=True))
        return [fresh[p[:-1]] + fresh[p[-1]] if m else fresh[p] for p, m in zip(pieces, marked, strict=True)]

    def _cut(self, texts: pa.Array) -> list[bytes]:
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n")
        lists = pc.split_pattern(marked, "\0")
        pieces = lists.flatten().dictionary_encode()
        distinct, bounds = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), lists.offsets.to_numpy()
        known = self.known.get
        at = np.fromiter([known(p, -1) for p in distinct], np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        ids, begin = self.ids, self.begin
        if len(new):
            names = [distinct[k] for k in new.tolist()]
            raw = self._learn(names)
            at[new] = np.arange(len(new)) + len(begin) - 1
            ids = np.concatenate([ids, np.frombuffer(b"".join(raw), self.kind)])
            begin = np.concatenate([begin, begin[-1] + np.cumsum([len(x) for x in raw]) // ids.itemsize])
            if len(self.known) < self.CACHE:
                self.known.update(zip(names, at[new].tolist(), strict=True))
                self.ids, self.begin = ids, begin
        place = at[pieces.indices.to_numpy()]
        n = begin[place + 1] - begin[place]
        end = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        flat = ids[np.repeat(begin[place] - end[:-1], n) + np.arange(end[-1])].tobytes()
        cuts = (end[bounds - bounds[0]] * ids.itemsize).tolist()
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self._encode(texts)
        column = pa.array(texts, pa.large_string())
        whole = pc.match_substring_regex(column, self._whole)
        marks = whole.to_numpy(zero_copy_only=False).tolist()
        out = iter(self._cut(column.filter(pc.invert(whole))))
        plain = iter(self._encode([t for t, w in zip(texts, marks, strict=True) if w]))
        return [next(plain if w else out) for w in marks]


@functools.cache
def encoder(tokenizer_file: str, kind: str) -> Encoder:
    """One per Python worker, so that what it remembers serves all its tasks."""
    return Encoder(tokenizer_file, kind)


def tokenize(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, text) to (doc_id, n_tokens, ids): ids packed as packing() says, with the end id."""
    kind = packing(tokenizer_file, end_id)

    def start():
        encode, end = encoder(tokenizer_file, kind), np.array([end_id], kind).tobytes()

        def run(batch: pa.RecordBatch) -> list[pa.Array]:
            column, out = batch.column("text"), []
            for k in range(0, len(column), BATCH_ROWS):
                texts = [t or "" for t in column.slice(k, BATCH_ROWS).to_pylist()]
                for s in by_chars(texts, BATCH_CHARS):
                    out += [ids + end for ids in encode(texts[s])]
            return [pa.array([len(x) // len(end) for x in out], pa.int64()), pa.array(out, pa.binary())]

        return run

    return beside(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], ["text"], "n_tokens long, ids binary", start)


def id_counts(ids: DataFrame, kind: str) -> np.ndarray:
    """Occurrences by id over all documents; each task sends one row per distinct id at most."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(0, np.int64)
        for pdf in batches:
            own = np.bincount(np.frombuffer(b"".join(pdf["ids"]), kind))
            if len(own) > len(total):
                own, total = total, own
            total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pd.DataFrame({"id": used, "n": total[used]})

    rows = ids.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    return counts


def _segments(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    docs: list[int | None] = []
    parts: list = []
    held, width = 0, int(kind[-1])
    for batch in batches:
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if held and held + len(raw) // width > SEGMENT:
                yield docs, np.array([len(x) // width for x in parts], "<u4"), np.frombuffer(b"".join(parts), kind)
                docs, parts, held = [], [], 0
            docs.append(doc_id)
            parts.append(raw)
            held += len(raw) // width
    if docs:
        yield docs, np.array([len(x) // width for x in parts], "<u4"), np.frombuffer(b"".join(parts), kind)


def write_archive(ids: DataFrame, kind: str, folder: str, files: int, lengths: np.ndarray) -> DataFrame:
    """Write a (materialized) table of ids as coded files in order of doc_id; returns (file, path, n_tokens)."""
    codes = huffman.canonical_codes(lengths)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = TaskContext.get().partitionId()
        path, total, head = f"{folder}/part-{k:06d}.slh", 0, zlib.compress(lengths.tobytes())
        segments = _segments(batches, kind)
        first = next(segments, None)
        if first is None:
            return
        with replacing(path) as out:
            out.write(MAGIC + struct.pack("<II", len(lengths), len(head)) + head)
            for docs, counts, flat in [first]:
                total += _write_segment(out, docs, counts, flat, lengths, codes)
            for docs, counts, flat in segments:
                total += _write_segment(out, docs, counts, flat, lengths, codes)
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([path]), pa.array([total], pa.int64())], ["file", "path", "n_tokens"])

    # rows of one id, or of none, and even equal rows may make up several files
    order = [F.col("doc_id").asc_nulls_first(), F.col("own"), F.col("k")]
    ranged = ids.select("doc_id", "ids", F.xxhash64("ids").alias("own"), F.monotonically_increasing_id().alias("k")).repartitionByRange(files, *order).sortWithinPartitions(*order)
    return materialize(ranged.select("doc_id", "ids").mapInArrow(write, "file int, path string, n_tokens long"))


def _write_segment(out, docs: list[int | None], counts: np.ndarray, flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> int:
    bits, checkpoints = huffman.encode(flat, lengths, codes)
    body = np.array([d or 0 for d in docs], "<i8").tobytes() + counts.tobytes() + checkpoints.astype("<u8").tobytes() + bits
    out.write(_HEAD.pack(len(docs), docs.count(None), len(flat), len(checkpoints), len(bits), zlib.crc32(body)) + body)
    return len(flat)


def read_file(path: str) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Segments of a file, as (doc_ids, counts, ids)."""
    with reading(path) as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path}: not an archive of ids")
        n, size = struct.unpack("<II", f.read(8))
        codes = huffman.decode_table(np.frombuffer(zlib.decompress(f.read(size)), np.uint8, n))
        while head := f.read(_HEAD.size):
            n_docs, n_none, n_ids, n_points, n_bits, crc = _HEAD.unpack(head)
            body = f.read(12 * n_docs + 8 * n_points + n_bits)
            if zlib.crc32(body) != crc:
                raise ValueError(f"{path}: a damaged segment")
            docs, counts = np.frombuffer(body, "<i8", n_docs), np.frombuffer(body, "<u4", n_docs, 8 * n_docs)
            points = np.frombuffer(body, "<u8", n_points, 12 * n_docs)
            yield [None] * n_none + docs[n_none:].tolist(), counts, huffman.decode(body[12 * n_docs + 8 * n_points :], points, n_ids, codes)


def read_archive(written: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files that write_archive() lists; start counts the ids of all documents before."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                for docs, counts, flat in read_file(path):
                    ends = np.cumsum(counts, dtype=np.int64)
                    starts = ends - counts
                    raw = flat.astype("<u4").tobytes()
                    ids = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(base + starts), pa.array(counts.astype(np.int64)), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
                    base += len(flat)

    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = written.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    return files.repartition(max(1, written.count())).select("path", "base").mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def encode_documents(docs: DataFrame, tokenizer_file: str | None = None) -> tuple[DataFrame, str]:
    """Tokenize (doc_id, text), write the archive to the shared folder; returns its list of files and that folder."""
    tokenizer_file = tokenizer_file or default_tokenizer()
    kind = packing(tokenizer_file)
    ids = materialize(tokenize(docs, tokenizer_file))
    total = ids.agg(F.sum("n_tokens")).first()[0] or 0
    folder = shared_dir(docs.sparkSession)
    return write_archive(ids, kind, folder, max(1, -(-total // FILE_TOKENS)), huffman.code_lengths(id_counts(ids, kind))), folder


def digest(decoded: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): unsigned CRC-32 of a document's ids as stored."""
    return decoded.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    written, _ = encode_documents(table(spark, sf_dir, "documents"))
    return digest(read_archive(written))
