"""Exact removal of repeated byte strings by suffix arrays.

Every byte covered by a string of LENGTH bytes that also starts anywhere else goes. Strings are dealt to tasks by content: each
window of LENGTH bytes has an anchor, the least hashed GRAM-byte string inside it, and equal windows have equal anchors at equal
offsets. Consecutive windows with one anchor form a region. So:

1. Count anchors and regions; regions whose anchor occurs once hold no repeated window and go no further.
2. Keep the places of the others, and cut one copy of each different region out of the texts.
3. Regions with one anchor meet in one task, which builds a suffix array of them by two-stage sorting and reads repeated windows off
   the common prefixes of neighbours (or off the count of equal regions). An anchor with over GROUP different regions, such as
   one near the edge of a passage that is everywhere, has them cut into cells of windows, which are sorted the same way with those
   that share the cell's core; cores with over GROUP different cells are cut into windows, dealt by their own bytes. Pieces
   that are equal as a whole are counted as copies first and so are repeated; what pieces share in part is read off suffix arrays.
   A key brings a task GROUP pieces at most, or a very common window a row for each batch it was read in.
4. Send the repeated windows back to all places of their regions and remove what they cover.

Texts are copied once into the shared folder; the steps go over its files and side tables go to the file they belong to, so
texts aren't shuffled again.

Defined cases: null text is empty; a document shorter than LENGTH keeps everything; repeated rows are places of their own and so
repeat each other; a null doc_id is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import materialize, table
from spanlink.llm.files import resolve, text_files
from spanlink.llm.suffix import common_prefixes, suffix_array

LENGTH, GRAM, CELL = 200, 32, 8
#: Different regions of an anchor that one task may get; bytes of regions in one suffix array, and of texts in a file, about.
GROUP, SORTED_BYTES, FILE_BYTES = 1024, 1 << 20, 16 << 20
BATCH_BYTES = 1 << 20
_SPAN = LENGTH - GRAM + 1
#: Bytes that all windows of a whole cell share.
_CORE = LENGTH - CELL + 1
#: Places share a word with the high bits of hashes; no text of Spark's is longer.
_PLACE = np.uint64((1 << 31) - 1)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@functools.lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = (1 << bits) + 1
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class _Hashes:
    """Hashes of any stretch of some bytes, from running sums."""

    def __init__(self, data: np.ndarray, base: int):
        up, self.down = _powers(base, max(20, len(data).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive keys."""
    n = len(keys)
    blocks = np.concatenate([keys, np.full(-n % width, np.iinfo(keys.dtype).max, keys.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    return np.minimum(ahead[: n - width + 1], behind[width - 1 : n])


def regions(data: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
    """Regions of texts that lie one after the other in `data`.

    doc (its number), lo (first window), n (windows), off (anchor from lo), h (anchor hash), rh (region hash).
    """
    ends = np.cumsum(lengths)
    starts = np.arange(max(0, len(data) - LENGTH + 1))
    doc = np.repeat(np.arange(len(lengths)), lengths)[: len(starts)]
    inside = np.flatnonzero(starts + LENGTH <= ends[doc]) if len(starts) else starts
    if not len(inside):
        return {c: np.empty(0, np.int64) for c in ("doc", "lo", "n", "off", "h", "rh")}
    first, second = (_Hashes(data, b) for b in _BASES)
    grams = np.arange(len(data) - GRAM + 1)
    hashed = first(grams, grams + GRAM)
    anchor = (_least((hashed & ~_PLACE) | grams.astype(np.uint64), _SPAN) & _PLACE).astype(np.int64)[inside]
    new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.append(new[1:], len(inside)) - 1
    lo, hi, place = inside[new], inside[last], anchor[new]
    own = doc[lo]
    return {"doc": own, "lo": lo - (ends - lengths)[own], "n": hi - lo + 1, "off": place - lo, "h": hashed[place].view(np.int64), "rh": second(lo, hi + LENGTH).view(np.int64)}


def _batches(path: str, ids: bool = False) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(number of the first row, ids, texts' bytes one after the other, their lengths) of a file of the copy, about BATCH_BYTES at a time.

    Rows are read so many at once that they hold about 8 * BATCH_BYTES by the file's mean.
    """
    fs, local = resolve(path)
    at = 0
    with fs.open_input_file(local) as f:
        table = pq.ParquetFile(f)
        size = sum(table.metadata.row_group(k).total_byte_size for k in range(table.metadata.num_row_groups))
        rows = max(1, min(1024, 8 * BATCH_BYTES * table.metadata.num_rows // max(1, size)))
        for batch in table.iter_batches(batch_size=rows, columns=["doc_id", "text"] if ids else ["text"]):
            text = batch.column("text")
            text = pc.fill_null(text.cast(pa.large_binary()), b"")
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            raw = np.frombuffer(text.buffers()[2] or b"", np.uint8)
            names = batch.column("doc_id") if ids else pa.nulls(len(text), pa.int64())
            a = 0
            while a < len(text):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + BATCH_BYTES, side="right")) - 1)
                yield at + a, names.slice(a, b - a), raw[offsets[a] : offsets[b]], np.diff(offsets[a : b + 1])
                a = b
            at += len(text)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for files in batches:
        for path in files.column("path").to_pylist():
            for _, _, data, lengths in _batches(path):
                r = regions(data, lengths)
                _, one, n = np.unique(_both(r), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({"h": r["h"][one], "rh": r["rh"][one], "n": n})


def _both(r: dict[str, np.ndarray]) -> np.ndarray:
    return r["rh"].view(np.uint64) * np.uint64(_BASES[0]) + r["h"].view(np.uint64)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per different region of a document, with the list of its places."""
    for files in batches:
        for file, path in zip(files.column("file").to_pylist(), files.column("path").to_pylist(), strict=True):
            for at, _, data, lengths in _batches(path):
                r = regions(data, lengths)
                key = _both(r)
                order = np.lexsort((r["lo"], key, r["doc"]))
                key, doc = key[order], r["doc"][order]
                new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(order) else order
                one = order[new]
                los = pa.ListArray.from_arrays(pa.array(np.append(new, len(order)).astype(np.int32)), pa.array(r["lo"][order].astype(np.int32)))
                yield pa.RecordBatch.from_pydict({"file": pa.array([file] * len(one), pa.int64()), "doc": r["doc"][one] + at, "h": r["h"][one], "rh": r["rh"][one], "windows": r["n"][one].astype(np.int32), "off": r["off"][one].astype(np.int32), "los": los})


def _cut(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One copy of each of the regions that lie in one file."""
    pdf = pdf.sort_values("doc")
    docs, out = pdf["doc"].to_numpy(), []
    for at, _, data, lengths in _batches(pdf["path"].iloc[0]):
        a, b = np.searchsorted(docs, at), np.searchsorted(docs, at + len(lengths))
        start = (np.cumsum(lengths) - lengths)[docs[a:b] - at] + pdf["lo"].to_numpy()[a:b]
        out += [data[x : x + n + LENGTH - 1].tobytes() for x, n in zip(start.tolist(), pdf["windows"].to_numpy()[a:b].tolist(), strict=True)]
    return pdf[["h", "rh", "copies", "kinds", "off"]].assign(region=out)


def _runs(flags: np.ndarray) -> list[int]:
    """Starts and ends (exclusive) of the runs of set flags."""
    return np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))).tolist()


def repeated_windows(parts: list[bytes], copies: np.ndarray) -> list[np.ndarray]:
    """For each region its windows' flags: whether the window occurs in another place; copies: places of each region."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    text = np.frombuffer(b"\0".join([*parts, b""]), np.uint8).astype(np.int64) + 1
    ends = np.cumsum(lengths + 1) - 1
    text[ends] = 0  # after each region, below all bytes
    owner = np.repeat(np.arange(len(parts)), lengths + 1)
    fits = np.arange(len(text)) + LENGTH <= ends[owner]
    order = suffix_array(text, LENGTH, fits)
    whole = common_prefixes(text, order, LENGTH) >= LENGTH
    fits = fits[order]  # a common prefix that runs over an end is none
    flags = np.zeros(len(text), bool)
    pair = np.flatnonzero(whole & fits & np.concatenate([fits[:1], fits[:-1]]))
    flags[order[pair]] = True
    flags[order[pair - 1]] = True
    out = []
    for k, (n, end) in enumerate(zip(lengths, ends, strict=True)):
        own = flags[end - n : end - LENGTH + 1]
        out.append(np.ones(len(own), bool) if copies[k] > 1 else own)
    return out


def _sorted(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of the regions of some anchors, about SORTED_BYTES at a time, an anchor's regions together."""
    pdf = pdf.sort_values(["h", "rh"])
    h, size, a, held = pdf["h"].to_numpy(), pdf["region"].map(len).to_numpy(), 0, 0
    out: list[list[int]] = []
    for b in range(1, len(pdf) + 1):
        held += size[b - 1]
        if b == len(pdf) or held >= SORTED_BYTES and h[b] != h[b - 1]:
            part = pdf.iloc[a:b]
            out += [_runs(f) for f in repeated_windows(part["region"].tolist(), part["copies"].to_numpy())]
            a, held = b, 0
    return pdf[["h", "rh"]].assign(runs=out)


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Regions in cells of CELL windows, aligned to the anchor: bytes of the cell, hashes of them and of the core that its windows share."""
    for pdf in batches:
        for s in range(0, len(pdf), 1024):
            part = pdf.iloc[s : s + 1024]
            sizes, off = part["region"].map(len).to_numpy(), part["off"].to_numpy(np.int64)
            raw = b"".join(part["region"])
            first, second = (_Hashes(np.frombuffer(raw, np.uint8), x) for x in _BASES)
            n = sizes - LENGTH + 1
            k = np.repeat(np.arange(len(part)), n)
            rel = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            base = np.cumsum(sizes) - sizes
            number = (rel - off[k]) // CELL
            new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (number[1:] != number[:-1])]))
            last = np.append(new[1:], len(k)) - 1
            lo, hi = base[k[new]] + rel[new], base[k[last]] + rel[last] + LENGTH
            core = base[k[new]] + off[k[new]] + CELL * number[new] + CELL - 1
            hashes = {c: f(x, y).view(np.int64) for c, f, x, y in (("c1", first, core, core + _CORE), ("c2", second, core, core + _CORE), ("k1", first, lo, hi), ("k2", second, lo, hi))}
            own = part[["h", "rh", "copies"]].iloc[k[new]].reset_index(drop=True)
            yield own.assign(start=rel[new], piece=[raw[x:y] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], **hashes)


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cells window by window."""
    for pdf in batches:
        for s in range(0, len(pdf), 1024):
            part = pdf.iloc[s : s + 1024].reset_index(drop=True)
            n = part["piece"].map(len).to_numpy() - LENGTH + 1
            k = np.repeat(np.arange(len(part)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            pieces = part["piece"].tolist()
            yield part[["k1", "k2", "copies"]].iloc[k].reset_index(drop=True).assign(at=at, region=[pieces[i][x : x + LENGTH] for i, x in zip(k.tolist(), at.tolist(), strict=True)])


def _combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Equal windows of a batch as one row, so that a very common window reaches its task as few rows."""
    for pdf in batches:
        yield pdf.groupby(["h", "rh", "region"], as_index=False, sort=False)["copies"].sum()


def sort_groups(cut: DataFrame) -> DataFrame:
    """(h, rh, runs): repeated windows of regions (h, rh, copies, region), sorted in buckets that hold all regions of an h.

    Buckets hold about 2 * SORTED_BYTES, and there are as many as shuffle partitions at least.
    """
    total = cut.agg(F.sum(F.length("region"))).first()[0] or 0
    buckets = max(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (2 * SORTED_BYTES)))
    bucket = F.pmod(F.xxhash64("h"), F.lit(buckets)).cast("int")
    return cut.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_sorted, "h long, rh long, runs array<int>").where(F.size("runs") > 0)


def split_groups(cut: DataFrame) -> DataFrame:
    """(h, rh, runs) of regions whose anchors have too many kinds for one task: their cells are sorted by core, or else their windows.

    Equal windows at one anchor lie in cells of equal cores, so cells whose core occurs once go no further, and those with one core are
    sorted together. The windows of cores that have too many kinds themselves are dealt by their own content.
    """
    cells = materialize(cut.mapInPandas(_cells, "h long, rh long, copies long, start int, piece binary, c1 long, c2 long, k1 long, k2 long"))
    kinds = materialize(cells.groupBy("c1", "c2", "k1", "k2").agg(F.sum("copies").alias("copies"), F.any_value("piece").alias("piece")))
    cores = kinds.groupBy("c1", "c2").agg(F.sum("copies").alias("places"), F.count("*").alias("kinds")).where("places > 1")
    wanted = materialize(kinds.join(cores, ["c1", "c2"]).withColumn("h", F.xxhash64("c1", "c2")))
    by_core = sort_groups(wanted.where(F.col("kinds") <= GROUP).select("h", F.col("k1").alias("rh"), "k2", "copies", F.col("piece").alias("region")))
    # starts and ends take turns
    spans = F.transform(F.sequence(F.lit(0), F.size("runs") - 2, F.lit(2)), lambda k: F.struct(F.get("runs", k).alias("at"), F.get("runs", k + 1).alias("end")))
    few = by_core.select("h", F.col("rh").alias("k1"), F.explode(spans).alias("r")).select("h", "k1", "r.*")
    few = wanted.select("h", "k1", "k2").join(few, ["h", "k1"]).select("k1", "k2", "at", (F.col("end") - F.col("at")).alias("n"))

    windows = wanted.where(F.col("kinds") > GROUP).mapInPandas(_windows, "k1 long, k2 long, copies long, at int, region binary")
    windows = materialize(windows.withColumn("h", F.xxhash64("region")).withColumn("rh", F.xxhash64("region", F.lit(1))))
    again = sort_groups(materialize(windows.select("h", "rh", "copies", "region").mapInPandas(_combined, "h long, rh long, region binary, copies long")))
    many = windows.join(again.select("h", "rh").distinct(), ["h", "rh"]).select("k1", "k2", "at", F.lit(1).alias("n"))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for pieces in pdf["pieces"]:
                flags = np.zeros(_SPAN, bool)
                for p in pieces:
                    flags[p["start"] : p["start"] + p["n"]] = True
                out.append(_runs(flags))
            yield pdf[["h", "rh"]].assign(runs=out)

    found = materialize(few.unionByName(many))
    back = cells.select("h", "rh", "start", "k1", "k2").join(found, ["k1", "k2"]).select("h", "rh", (F.col("start") + F.col("at")).alias("start"), "n")
    pieces = back.groupBy("h", "rh").agg(F.collect_list(F.struct("start", "n")).alias("pieces"))
    return pieces.mapInPandas(runs, "h long, rh long, runs array<int>")


def _kept(paths: list[str], side: pd.DataFrame, keep_bytes: bool) -> Iterator[pa.RecordBatch]:
    side = side.sort_values("doc")
    docs = side["doc"].to_numpy()
    los, runs = side["los"].tolist(), side["runs"].tolist()
    for path in paths:
        for at, names, data, lengths in _batches(path, ids=True):
            starts = np.cumsum(lengths) - lengths
            edges = np.zeros(len(data) + 1, np.int32)
            a, b = np.searchsorted(docs, at), np.searchsorted(docs, at + len(lengths))
            for i, base in zip(range(a, b), starts[docs[a:b] - at].tolist(), strict=True):
                for lo in los[i]:
                    edges[np.asarray(runs[i][0::2]) + (base + lo)] += 1
                    edges[np.asarray(runs[i][1::2]) + (base + lo + LENGTH - 1)] -= 1
            gone, out = np.cumsum(edges[:-1]) > 0, []
            for x, n in zip(starts.tolist(), lengths.tolist(), strict=True):
                own = gone[x : x + n]
                kept = data[x : x + n][~own].tobytes()
                spans = int(np.count_nonzero(own[1:] & ~own[:-1])) + int(n > 0 and own[0])
                out.append((n, n - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: 4 + keep_bytes]
            arrays = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([names, *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + keep_bytes])


def remove_repeats(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row of (doc_id, text); kept: the remaining bytes."""
    files = text_files(docs, FILE_BYTES).select("file", "path")
    n_files = files.count()
    spread = files.repartition(max(1, n_files))

    counted = materialize(spread.select("path").mapInArrow(_count, "h long, rh long, n long").groupBy("h", "rh").agg(F.sum("n").alias("copies")))
    anchors = counted.groupBy("h").agg(F.sum("copies").alias("places"), F.count("*").alias("kinds")).where("places > 1")
    wanted = materialize(counted.join(anchors.select("h", "kinds"), "h"))
    places = spread.mapInArrow(_places, "file long, doc long, h long, rh long, windows int, off int, los array<int>")
    # sizes of what comes out of Python are guesses, too low for a list of files, so no side may be broadcast on their word
    places = materialize(places.join(wanted.hint("merge"), ["h", "rh"]))

    # where all regions of an anchor are one, counting has settled all of its windows
    settled = places.where("kinds = 1").select("h", "rh", F.array(F.lit(0), "windows").alias("runs")).distinct()
    one = F.min(F.struct("file", "doc", "windows", "off", F.get("los", F.lit(0)).alias("lo"))).alias("p")
    copies = places.where("kinds > 1").groupBy("h", "rh", "copies", "kinds").agg(one).select("h", "rh", "copies", "kinds", "p.*").join(files, "file")
    cut = materialize(copies.groupBy("file").applyInPandas(_cut, "h long, rh long, copies long, kinds long, off int, region binary"))

    found = sort_groups(cut.where(F.col("kinds") <= GROUP)).unionByName(split_groups(cut.where(F.col("kinds") > GROUP))).unionByName(settled)
    side = places.select("file", "doc", "h", "rh", "los").join(materialize(found), ["h", "rh"]).select("file", "doc", "los", "runs")

    def run(files: pa.Table, side: pa.Table) -> pa.Table:
        return pa.Table.from_batches(_kept(files.column("path").to_pylist(), side.to_pandas(), keep_bytes))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return files.groupBy("file").cogroup(side.groupBy("file")).applyInArrow(run, schema)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)


#: Texts as hexadecimal, two characters a byte; windows are compared by their MD5 numbers.
OP6_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS MATERIALIZED (SELECT row, i, md5_number(substr(x, 2 * i + 1, {2 * LENGTH})) AS h FROM (SELECT row, x, unnest(range(0, length(x) // 2 - {LENGTH - 1})) AS i FROM d)),
hit AS (SELECT row, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
opened AS (SELECT row, i, i > lag(i) OVER (PARTITION BY row ORDER BY i) + {LENGTH} AS apart FROM hit),
numbered AS (SELECT row, i, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY row ORDER BY i) AS k FROM opened),
span AS (SELECT row, k, min(i) AS a, max(i) + {LENGTH} AS b FROM numbered GROUP BY row, k),
gap AS (SELECT row, a, b, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS before FROM span),
cut AS (SELECT row, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS last, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM gap JOIN d USING (row) GROUP BY row)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE concat(kept, substr(x, 2 * last + 1)) END)) AS kept_sha256 FROM d LEFT JOIN cut USING (row)
"""
