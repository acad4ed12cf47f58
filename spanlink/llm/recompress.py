"""Removal of word sequences that an earlier document holds, found by recompression.

Texts are words. A step of recompression renames runs of one symbol, or pairs of a left and a right symbol; which side a symbol is on follows from
its name alone, so equal stretches of any two texts are renamed alike, but for at most a symbol at each end. A window of WIDTH words therefore
has an interior in each step, which depends on its words only: what might be renamed together with something outside is popped off
at its ends. Names are hashes of what they stand for, so all tasks agree on them without a dictionary.

1. Each Spark round does some steps and brings the names in the interiors of windows together from all documents. Names that one
   document alone holds can't be part of a repeat: windows with such a name in their interior drop out, and what only they hold isn't
   sent in later rounds.
2. The windows left get a name of their own, folded from what was popped and the last interior, and a second hash of their words, which must agree too
   (96 bits). The least doc_id of each goes back to the files that hold a later document of it.

Texts are copied once into the shared folder, in files of about FILE_BYTES. Names are combined per file and shuffled in compressed blocks, a
block for each file and bucket of names, there and back; a passage that is everywhere is one name a file, and no task holds more of it. Texts longer than UNIT_WORDS words are read in stretches that overlap by WIDTH - 1 words, which changes no
window's interior.

Defined cases: null and empty texts have no words; a document shorter than WIDTH keeps everything; rows of one doc_id are no earlier
documents of each other; a row with a null doc_id is neither earlier nor later than others and keeps everything; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlink.llm.common import materialize, table
from spanlink.llm.files import resolve, text_files

WIDTH = 13
#: Pair steps of each Spark round; the first round begins with a step on runs.
ROUNDS = (4,)
FILE_BYTES, CHUNK_BYTES, UNIT_WORDS = 16 << 20, 1 << 20, 1 << 18
#: Bytes of text whose names, of all files, meet in a task.
BUCKET_BYTES = 64 << 20
MAX_TASKS = 100_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _name(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    """Name of an ordered pair; kinds of pairs never share names."""
    return _mixed(_mixed(a + np.uint64(kind)) * _ODD + b)


class Parse:
    """Symbols of some words step by step, and the interiors of all windows.

    start, name, owner: first word, name and text of each symbol; at: the symbol of each word. Windows: first (word), lo and hi (words of the
    interior), left and right (folded names of what was popped).
    """

    def __init__(self, names: np.ndarray, owner: np.ndarray, width: int, wanted: np.ndarray):
        n = len(names)
        self.n, self.name, self.owner, self.start = n, names, owner, np.arange(n)
        self.at = np.arange(n + 1)
        first = np.arange(max(0, n - width + 1))
        self.first = first[(owner[first] == owner[first + width - 1]) & wanted[first]]
        self.lo, self.hi = self.first.copy(), self.first + width
        self.left, self.right = (np.zeros(len(self.first), np.uint64) for _ in range(2))
        self.steps = 0

    def _next(self, new: np.ndarray, name: np.ndarray) -> None:
        """Only symbols flagged in `new` begin one of the next level."""
        self.start, self.owner, self.name = self.start[new], self.owner[new], name[new]
        begins = np.zeros(self.n + 1, np.int64)
        begins[self.start] = 1
        begins[self.n] = 1
        self.at = np.cumsum(begins) - 1
        self.steps += 1

    def runs(self) -> None:
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.owner[1:] != self.owner[:-1])
        begin = np.flatnonzero(new)
        ends = np.append(self.start[begin[1:]], self.n)  # in words, by runs
        number = np.cumsum(new) - 1
        size = np.diff(np.append(begin, len(new)))
        name = self.name.copy()
        longer = begin[size > 1]
        name[longer] = _name(self.name[longer], size[size > 1].astype(np.uint64), 1)
        w = np.flatnonzero(self.lo < self.hi)
        s = self.at[self.lo[w]]
        lo = np.minimum(ends[number[s]], self.hi[w])
        self.left[w] = _name(_name(self.left[w], self.name[s], 2), (lo - self.lo[w]).astype(np.uint64), 3)
        self.lo[w] = lo
        w = w[lo < self.hi[w]]
        s = self.at[self.hi[w] - 1]
        hi = np.maximum(self.start[begin[number[s]]], self.lo[w])
        self.right[w] = _name(_name(self.right[w], self.name[s], 2), (self.hi[w] - hi).astype(np.uint64), 3)
        self.hi[w] = hi
        self._next(new, name)

    def pairs(self) -> None:
        follower = (_mixed(self.name + np.uint64(97 + self.steps)) & np.uint64(1)).astype(bool)
        paired = np.zeros(len(self.name), bool)
        paired[:-1] = ~follower[:-1] & follower[1:] & (self.owner[:-1] == self.owner[1:])
        name = self.name.copy()
        a = np.flatnonzero(paired)
        name[a] = _name(self.name[a], self.name[a + 1], 4)
        new = np.ones(len(self.name), bool)
        new[a + 1] = False
        after = np.append(self.start[1:], self.n)
        w = np.flatnonzero(self.lo < self.hi)
        s = self.at[self.lo[w]]
        w, s = w[follower[s]], s[follower[s]]
        self.left[w] = _name(self.left[w], self.name[s], 5)
        self.lo[w] = after[s]
        w = np.flatnonzero(self.lo < self.hi)
        s = self.at[self.hi[w] - 1]
        w, s = w[~follower[s]], s[~follower[s]]
        self.right[w] = _name(self.right[w], self.name[s], 5)
        self.hi[w] = self.start[s]
        self._next(new, name)

    def round(self, k: int, pair_steps: int) -> None:
        if k == 0:
            self.runs()
        for _ in range(pair_steps):
            self.pairs()

    def keep(self, flags: np.ndarray) -> None:
        """Only the flagged windows go on."""
        self.first, self.lo, self.hi, self.left, self.right = (x[flags] for x in (self.first, self.lo, self.hi, self.left, self.right))

    def drop_lone(self, shared: np.ndarray) -> None:
        """Drop windows with a symbol of several words in the interior whose name isn't in the (sorted) shared ones."""
        lone = np.diff(np.append(self.start, self.n)) > 1
        lone[lone] = ~_within(self.name[lone], shared)
        before = np.concatenate([[0], np.cumsum(lone)])
        self.keep((self.lo >= self.hi) | (before[self.at[self.hi]] == before[self.at[self.lo]]))

    def inside(self) -> np.ndarray:
        """Symbols of several words in some window's interior."""
        edges = np.zeros(len(self.name) + 1, np.int64)
        some = self.lo < self.hi
        np.add.at(edges, self.at[self.lo[some]], 1)
        np.add.at(edges, self.at[self.hi[some]], -1)
        return np.flatnonzero((np.cumsum(edges[:-1]) > 0) & (np.diff(np.append(self.start, self.n)) > 1))

    def window_names(self) -> np.ndarray:
        ends = _stretch(self.name, self.at[np.minimum(self.lo, self.hi)], self.at[self.hi])
        return _name(_name(self.left, self.right, 6), ends, 7)


def _within(names: np.ndarray, sorted_names: np.ndarray) -> np.ndarray:
    if not len(sorted_names):
        return np.zeros(len(names), bool)
    at = np.minimum(np.searchsorted(sorted_names, names), len(sorted_names) - 1)
    return sorted_names[at] == names


@functools.lru_cache(maxsize=8)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = (np.full(1 << bits, x, np.uint64) for x in (int(_ODD), pow(int(_ODD), -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _stretch(names: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of names[a:b], from running sums."""
    up, down = _powers(max(16, len(names).bit_length()))
    sums = np.zeros(len(names) + 1, np.uint64)
    np.cumsum(names * up[: len(names)], out=sums[1:])
    return _mixed((sums[b] - sums[a]) * down[a])


def split(text: bytes) -> Iterator[list[bytes]]:
    """Words, those of about CHUNK_BYTES at a time."""
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK_BYTES)
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        yield text[at:end].split()  # of bytes: at ASCII white space
        at = end


def units(texts: Iterable[bytes], width: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int, int]]]]:
    """Words of texts, about UNIT_WORDS together, and spans (text, number of its first word here, first and last word here)."""
    words: list[bytes] = []
    spans: list[tuple[int, int, int, int]] = []
    for k, text in enumerate(texts):
        done = 0
        for part in split(text):
            words += part
            begun = spans and spans[-1][0] == k
            if begun:
                spans[-1] = (*spans[-1][:3], len(words))
            elif part:
                spans.append((k, done, len(words) - len(part), len(words)))
            done += len(part)
            if len(words) >= UNIT_WORDS:
                yield words, spans
                own = min(width - 1, done, len(words) - spans[-1][2])
                words = words[len(words) - own :]
                spans = [(k, done - own, 0, own)]
    if words:
        yield words, spans


def _names(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each word."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def _read(path: str) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(doc_ids, texts) of a file, some rows at a time."""
    fs, local = resolve(path)
    with fs.open_input_file(local) as f:
        for batch in pq.ParquetFile(f).iter_batches(batch_size=512):
            yield batch.column("doc_id"), [t or b"" for t in batch.column("text").to_pylist()]


def _parsed(ids: pa.Array, texts: list[bytes], width: int) -> Iterator[tuple[Parse, np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]]:
    """(parse, doc_id of each word, second names of the words, spans) of each unit of some texts."""
    known, value = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    for words, spans in units(texts, width):
        own = np.repeat([s[0] for s in spans], [s[3] - s[2] for s in spans])
        names, others = _names(words)
        yield Parse(names, own, width, known[own]), value[own], others, spans


def _distinct(keys: list[np.ndarray], docs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Keys in the order of the first one, and the least and the greatest doc_id of each; some keys that share the first one may come again."""
    order = np.argsort(keys[0])
    keys, docs = [k[order] for k in keys], docs[order]
    new = np.ones(len(docs), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    begin = np.flatnonzero(new)
    if not len(begin):
        return keys, docs, docs
    return [k[begin] for k in keys], np.minimum.reduceat(docs, begin), np.maximum.reduceat(docs, begin)


def _of_file(found: list[tuple[list[np.ndarray], np.ndarray]], n_keys: int) -> dict[str, np.ndarray]:
    """The distinct keys of a file with the least doc_id and how far the greatest is from it."""
    docs = np.concatenate([np.empty(0, np.int64), *[d for _, d in found]])
    keys = [np.concatenate([np.empty(0, np.uint64), *[k[j] for k, _ in found]]) for j in range(n_keys)]
    keys, low, high = _distinct(keys, docs)
    return dict(zip(("name", "check"), keys, strict=False)) | {"low": low, "more": high - low}


def _thinned(keys: list[np.ndarray], docs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys with their least and greatest doc_ids as two rows, or one."""
    keys, low, high = _distinct(keys, docs)
    more = high > low
    return [np.concatenate([k, k[more]]) for k in keys], np.concatenate([low, high[more]])


def _block(columns: dict[str, np.ndarray]) -> bytes:
    batch, out = pa.RecordBatch.from_pydict({c: pa.array(x) for c, x in columns.items()}), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _opened(blocks: list[bytes], names: tuple[str, ...]) -> dict[str, np.ndarray]:
    batches = [pa.ipc.open_stream(b).read_next_batch() for b in blocks]
    kinds = {"name": np.uint64, "check": np.uint32}
    return {c: np.concatenate([np.empty(0, kinds.get(c, np.int64)), *[b.column(c).to_numpy() for b in batches]]) for c in names}


def _dealt(file: int, columns: dict[str, np.ndarray], buckets: int) -> pa.Table:
    """(bucket, file, block): a file's rows by buckets of names."""
    bucket = (columns["name"] >> np.uint64(8)) % np.uint64(buckets)
    order = np.argsort(bucket.astype(np.uint32), kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
    rows = [(int(bucket[own[0]]), file, _block({c: x[own] for c, x in columns.items()})) for own in parts]
    return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else ((), (), ()), (pa.int32(), pa.int64(), pa.binary()), strict=True)], ["bucket", "file", "block"])


def symbol_rows(path: str, width: int, rounds: tuple[int, ...], shared: np.ndarray) -> dict[str, np.ndarray]:
    """Names of the last of some rounds in interiors of windows that earlier rounds have left."""
    found = []
    for ids, texts in _read(path):
        for parse, doc, _, _ in _parsed(ids, texts, width):
            for k, steps in enumerate(rounds):
                parse.round(k, steps)
                if k + 1 < len(rounds):
                    parse.drop_lone(shared)
            s = parse.inside()
            found.append(_thinned([parse.name[s]], doc[parse.start[s]]))
    return _of_file(found, 1)


def window_rows(path: str, width: int, rounds: tuple[int, ...], shared: np.ndarray) -> dict[str, np.ndarray]:
    """Names and checks of the windows that all rounds have left."""
    found = []
    for ids, texts in _read(path):
        for parse, doc, others, _ in _parsed(ids, texts, width):
            for k, steps in enumerate(rounds):
                parse.round(k, steps)
                parse.drop_lone(shared)
            check = _check(others, parse.first, width).astype(np.uint64)
            found.append(_thinned([parse.window_names(), check], doc[parse.first]))
    rows = _of_file(found, 2)
    return rows | {"check": rows["check"].astype(np.uint32)}


def _check(names: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    return (_stretch(names, first, first + width) >> np.uint64(32)).astype(np.uint32)


def meet(blocks: list[bytes], files: list[int], windows: bool) -> Iterator[tuple[int, bytes]]:
    """(file, block) from all files' blocks of some names: names that several documents hold, or windows with the least doc_id of an earlier document."""
    keys = ("name", "check") if windows else ("name",)
    opened = _opened(blocks, (*keys, "low", "more"))
    sizes = [pa.ipc.open_stream(b).read_next_batch().num_rows for b in blocks]
    file = np.repeat(np.array(files, np.int64), sizes)
    order = np.lexsort([opened[k] for k in reversed(keys)])
    rows = {c: x[order] for c, x in opened.items()}
    file, high = file[order], rows["low"] + rows["more"]
    new = np.ones(len(file), bool)
    new[1:] = np.any([rows[k][1:] != rows[k][:-1] for k in keys], axis=0)
    begin, group = np.flatnonzero(new), np.cumsum(new) - 1
    if not len(begin):
        return
    least, greatest = np.minimum.reduceat(rows["low"], begin), np.maximum.reduceat(high, begin)
    kept = high > least[group] if windows else (least < greatest)[group]
    out = {k: rows[k][kept] for k in keys} | ({"least": least[group][kept]} if windows else {})
    file = file[kept]
    by_file = np.argsort(file, kind="stable")
    for own in np.split(by_file, np.flatnonzero(np.diff(file[by_file])) + 1) if len(by_file) else []:
        yield int(file[own[0]]), _block({c: x[own] for c, x in out.items()})


def _least_of(name: np.ndarray, check: np.ndarray, side: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Least doc_id by the side's rows (name, check, doc_id), sorted by name, or the greatest number for windows without one."""
    names, checks, least = side
    out = np.full(len(name), np.iinfo(np.int64).max)
    at, unsure = np.searchsorted(names, name), np.arange(len(name))
    while len(unsure):  # on to the next row, where another window has the same name
        unsure = unsure[at[unsure] < len(names)]
        unsure = unsure[names[at[unsure]] == name[unsure]]
        hit = checks[at[unsure]] == check[unsure]
        out[unsure[hit]] = least[at[unsure[hit]]]
        unsure = unsure[~hit]
        at[unsure] += 1
    return out


def _digest(text: bytes, gone: np.ndarray | None, keep_text: bool) -> tuple[int, str, bytes | None]:
    """(words, SHA-256 of the words kept, the words kept)."""
    sha, n, kept, any_ = hashlib.sha256(), 0, [], False
    for part in split(text):
        own = part if gone is None else list(itertools.compress(part, ~gone[n : n + len(part)]))
        n += len(part)
        if own:
            joined = (b" " if any_ else b"") + b" ".join(own)
            any_ = True
            sha.update(joined)
            if keep_text:
                kept.append(joined)
    return n, sha.hexdigest(), b"".join(kept) if keep_text else None


def _removed(ids: pa.Array, texts: list[bytes], width: int, rounds: tuple[int, ...], side: tuple[np.ndarray, np.ndarray, np.ndarray]) -> dict[int, np.ndarray]:
    """Flags of the words that go, of the texts that lose any."""
    gone: dict[int, np.ndarray] = {}
    for parse, doc, others, spans in _parsed(ids, texts, width):
        for k, steps in enumerate(rounds):
            parse.round(k, steps)
        check = _check(others, parse.first, width)
        late = parse.first[doc[parse.first] > _least_of(parse.window_names(), check, side)]
        edges = np.zeros(parse.n + 1, np.int64)
        np.add.at(edges, late, 1)
        np.add.at(edges, late + width, -1)
        covered = np.cumsum(edges[:-1]) > 0
        for k, base, a, b in spans:
            if covered[a:b].any():
                flags = gone.setdefault(k, np.zeros(len(texts[k]) // 2 + 1, bool))
                flags[base : base + b - a] |= covered[a:b]
    return gone


def kept_rows(path: str, width: int, rounds: tuple[int, ...], side: tuple[np.ndarray, np.ndarray, np.ndarray], keep_text: bool) -> Iterator[pa.RecordBatch]:
    for ids, texts in _read(path):
        gone = _removed(ids, texts, width, rounds, side) if len(side[0]) else {}
        rows = [_digest(t, gone.get(k), keep_text) for k, t in enumerate(texts)]
        removed = [int(np.count_nonzero(gone[k])) if k in gone else 0 for k in range(len(texts))]
        columns = {"doc_id": ids, "n_words": pa.array([r[0] for r in rows], pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array([r[1] for r in rows])}
        yield pa.RecordBatch.from_pydict(columns | ({"kept": pa.array([r[2].decode() for r in rows], pa.string())} if keep_text else {}))


def remove_repeats(docs: DataFrame, width: int = WIDTH, rounds: tuple[int, ...] = ROUNDS, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) per row of (doc_id, text); kept: the remaining words joined by one space."""
    files = text_files(docs, FILE_BYTES)
    n_files, size = files.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    tasks = max(1, min(MAX_TASKS, n_files))
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    files = files.select("file", "path").repartition(tasks, "file")

    def with_files(side: DataFrame, run: Callable[[int, str, list[bytes]], pa.Table], schema: str) -> DataFrame:
        def one(files: pa.Table, side: pa.Table) -> pa.Table:
            blocks = side.column("block").to_pylist()
            return pa.concat_tables(run(f, p, blocks) for f, p in zip(files.column("file").to_pylist(), files.column("path").to_pylist(), strict=True))

        return files.groupBy("file").cogroup(side.repartition(tasks, "file").groupBy("file")).applyInArrow(one, schema)

    def together(dealt: DataFrame, windows: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks, owners = [], []
            for batch in batches:
                blocks += batch.column("block").to_pylist()
                owners += batch.column("file").to_pylist()
            for file, block in meet(blocks, owners, windows) if blocks else ():
                yield pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([block], pa.binary())], ["file", "block"])

        return dealt.repartition(buckets, "bucket").mapInArrow(run, "file long, block binary")

    def names(blocks: list[bytes]) -> np.ndarray:
        return np.sort(_opened(blocks, ("name",))["name"])

    shared = docs.sparkSession.createDataFrame([], "file long, block binary")
    for k in range(len(rounds)):
        found = with_files(shared, lambda f, p, blocks, k=k: _dealt(f, symbol_rows(p, width, rounds[: k + 1], names(blocks)), buckets), _DEALT)
        shared = shared.unionByName(together(found, False))
        shared = materialize(shared) if k + 1 < len(rounds) else shared  # a later round and the windows both read it
    windows = with_files(shared, lambda f, p, blocks: _dealt(f, window_rows(p, width, rounds, names(blocks)), buckets), _DEALT)

    def kept(file: int, path: str, blocks: list[bytes]) -> pa.Table:
        side = _opened(blocks, ("name", "check", "least"))
        order = np.argsort(side["name"], kind="stable")
        return pa.Table.from_batches(kept_rows(path, width, rounds, tuple(x[order] for x in side.values()), keep_text))

    return with_files(together(windows, True), kept, _KEPT + ", kept string" * keep_text)


_DEALT = "bucket int, file long, block binary"
_KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def op13_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS row, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS MATERIALIZED (SELECT doc_id, row, i, md5_number(array_to_string(ws[i:i + {WIDTH - 1}], ' ')) AS h FROM (SELECT doc_id, row, ws, unnest(range(1, len(ws) - {WIDTH - 2})) AS i FROM d)),
least AS (SELECT h, min(doc_id) AS first FROM w GROUP BY h),
hit AS (SELECT row, i FROM w JOIN least USING (h) WHERE doc_id > first),
gone AS (SELECT row, list(DISTINCT j) AS js FROM (SELECT row, unnest(range(i, i + {WIDTH})) AS j FROM hit) GROUP BY row),
word AS (SELECT row, unnest(ws) AS x, generate_subscripts(ws, 1) AS j FROM d),
kept AS (SELECT row, string_agg(x, ' ' ORDER BY j) AS t FROM word ANTI JOIN (SELECT row, unnest(js) AS j FROM gone) g USING (row, j) GROUP BY row)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN gone USING (row) LEFT JOIN kept USING (row)
"""
