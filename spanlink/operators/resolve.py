"""Citations with candidates to links: every rule on a citation's own text as a column beforehand, then one fold per book for what history decides.

1. `entries`: lists that the text itself cuts (chapter-led leaves, groups of verses) become rows of their own.
2. `options`: each target that a citation may get, with the rule that offers it: its candidates, and what it spells by itself.
3. `checked`: the vetoes and mends that need no history, for all options at once; what fails is gone before the fold.
4. `folded`: a book's citations in order. History is what was emitted last and the citation right before with its proven target. A
   citation that is dropped is no antecedent for the next "there"; what was rebuilt from text is emitted and trusted, but never
   becomes what is emitted last.

The fold is `step`, one function of (history, row); a table streams sorted partitions past it, and a stream keeps its history as state.

Steps 1 to 3 follow from what a line says and from the catalogs. Where few kinds of lines make up a table they run once a kind
(`kinds_of`, `of_kinds`), and the fold looks a line's rows up; in any other table they run for every line.

Citations: LINE, pos, content, start, end (code points), parts array<struct<label,text,start,end>> (relative to start), candidates
array<string> (empty: failed), context string (the line's own reference or null), place long (the line's place in its book, or null); optionally
own_title, own_he, section, section_last (see `recover`), and context_type: CURRENT_BOOK where the book's own reference decided the candidates.
Segments: ref, title, place, has_text. Works: title, aliases, category. Chapters: title, name, first, last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlink.functions import addresses, attribution, rules, text
from spanlink.operators import quotes, recover
from spanlink.operators.digests import content_hash
from spanlink.operators.recover import KEY, anchor, labels
from spanlink.schemas import BOOK, LINE, LINKS

Keep = Callable[[DataFrame], DataFrame]
ROW = [*KEY, "sub"]
#: Lines are resolved by kind if there are at most so many kinds, of so many characters of JSON (a task holds them), each of so many lines on average.
KINDS, KIND_CHARS, REPEATED = 1 << 16, 1 << 24, 4
#: What a task remembers of the fold: lines of one kind after one history go on alike.
REMEMBERED = 1 << 16
OPTION = "struct<kind:string,offered:string,ref:string,start:int,end:int,direction:string,shown:string>"
#: Rules that rebuild a citation from text in the order in which they are asked; `own` comes before the candidates.
FAILED = ("parenthesized", "chapter", "geresh")


def again(df: DataFrame) -> DataFrame:
    """Keeps nothing: a table is computed again wherever it is read."""
    return df


class History(NamedTuple):
    """What a book has said so far: the last emitted ordinary target, and the proven target of the citation right before."""

    last: str | None = None
    trusted: str | None = None


def title_of(ref: str) -> str:
    head, _, tail = ref.rpartition(" ")
    return head if head and tail[:1].isdigit() else ref


def _sections(ref: str) -> list[str]:
    return ref.rpartition(" ")[2].split(":")


def pick(candidates: list[str], same_as_above: bool, last: str | None) -> str | None:
    """The one candidate. Of several, only a "there" is decided: by the last reference, when all are of its book and just one has its outer sections."""
    if len(candidates) < 2:
        return candidates[0] if candidates else None
    if not same_as_above or last is None or len({title_of(r) for r in [*candidates, last]}) > 1:
        return None
    near = [c for c in candidates if len(_sections(c)) == len(_sections(last)) > 1 and _sections(c)[:-1] == _sections(last)[:-1]]
    return near[0] if len(near) == 1 else None


def step(history: History, row: dict) -> tuple[History, dict | None]:
    """The option that a citation takes, or None, and the history after it.

    row: labels, candidates, rebuilt, resets, own_context, outcomes (options that passed), address and homes ("there" with a printed leaf,
    and the titles in which that leaf has text), evidence (verses that the words beside the citation quote), verse (printed numbers).
    """
    is_a = set(row["labels"])
    candidates, outcomes = row["candidates"], row["outcomes"]
    rebuilt, failed = row["rebuilt"], not row["candidates"] and not row["rebuilt"]
    there, relative = "IBID" in is_a, "RELATIVE" in is_a
    by_kind = {o["kind"]: o for o in outcomes if o["kind"] != "candidate"}
    picked = None
    if not rebuilt and not (row["own_context"] and not relative):
        picked = pick(candidates, there, history.last)
    # a citation that this book drops is no antecedent for the next "there"
    last = history.last if failed or rebuilt and not row["resets"] else None
    taken = by_kind.get("given") if rebuilt else by_kind.get("own")
    kept = taken is not None and taken["kind"] == "own" and picked == taken["ref"]
    if taken is None and not rebuilt:
        if picked is not None:
            taken = next((o for o in outcomes if o["offered"] == picked), None)
        elif failed:
            taken = next((by_kind[k] for k in FAILED if k in by_kind), None)
        else:
            taken = by_kind.get("own_leaf")
        if taken is None and picked is None and not relative:
            taken = _continued(history.trusted, row) or by_kind.get("quoted")
    foreign = history.trusted is None or taken is not None and title_of(taken["ref"]) != title_of(history.trusted)
    if taken is not None and there and "NAMED" not in is_a and foreign and taken["kind"] not in ("own", "own_leaf", "quoted", "chapter_proven"):
        # "there" in another work than the citation before needs a proof of its own
        taken = by_kind.get("quoted") or (by_kind.get("chapter_proven") if picked is not None else None)
    if taken is not None and (taken["kind"] == "candidate" or kept):
        last = taken["ref"]
    return History(last, None if taken is None else taken["ref"]), taken


def _continued(trusted: str | None, row: dict) -> dict | None:
    """ "There" with a printed address of its own, in the work of the citation right before."""
    if trusted is None or "IBID" not in row["labels"]:
        return None
    title, ref = title_of(trusted), None
    if row["address"] is not None and title in row["homes"]:
        ref = f"{title} {row['address']}"
    elif row["verse"]:
        before = trusted[len(title) + 1 :].split(":")
        numbers = row["verse"] if len(row["verse"]) == 2 else [before[0], *row["verse"]]
        found = f"{title} {':'.join(map(str, numbers))}"
        # a printed verse may be wrong or no citation at all: the words beside it must be that verse's
        ref = found if len(before) == 2 and found in row["evidence"] else None
    return ref and {"kind": "continued", "offered": None, "ref": ref, "start": row["start"], "end": row["end"], "direction": None, "shown": None}


def entries(citations: DataFrame, segments: DataFrame, works: DataFrame | None = None, chapters: DataFrame | None = None, keep: Keep = again) -> DataFrame:
    """Citations with sub, rebuilt, resets, given and writer (who governs them): lists cut by their own text are a row for each address, all others as they are.

    Only the first row of a list that had candidates resets what was emitted last. Who writes before a list governs all of it.
    """
    citations = citations.withColumn("governed", attribution.governing(F.col("content"), F.col("start"), F.col("end"))).select("*", "governed.*").drop("governed")
    whole = {"sub": F.lit(0), "rebuilt": F.lit(False), "resets": F.size("candidates") > 0, "given": F.lit(None).cast("string")}
    if works is None or chapters is None:
        return citations.withColumns(whole)
    lists = recover.chapter_lists(citations, works, segments, chapters).withColumn("leaves", F.lit(True))
    verses = recover.split_verses(citations, works, segments).withColumn("leaves", F.lit(False)).join(lists.select(*KEY).distinct(), KEY, "left_anti")
    cut = keep(lists.unionByName(verses).select(*KEY, F.col("k").cast("int").alias("sub"), F.col("start").alias("g_start"), F.col("end").alias("g_end"), F.col("ref").alias("given"), "leaves"))
    plain = citations.join(cut.select(*KEY).distinct(), KEY, "left_anti").withColumns(whole)
    of_lists = citations.join(cut, KEY).withColumns(
        {"start": F.col("g_start"), "end": F.col("g_end"), "rebuilt": F.lit(True), "resets": F.col("leaves") & (F.col("sub") == 0) & (F.size("candidates") > 0), "parts": F.slice("parts", 1, 0)}
    )
    return plain.unionByName(of_lists.drop("g_start", "g_end", "leaves"))


def options(rows: DataFrame, segments: DataFrame, works: DataFrame | None = None, chapters: DataFrame | None = None, quoted: DataFrame | None = None) -> DataFrame:
    """(ROW, kind, offered, ref, start, end, direction) of all targets that rules offer for entries; spans as the rule found them.

    Without catalogs of works and chapters only the candidates (and quotations) are offered.
    """
    plain = rows.where("not rebuilt")
    none = {"offered": F.lit(None).cast("string"), "direction": F.lit(None).cast("string")}
    own_span = {"start": F.col("start"), "end": F.col("end")}

    def offered(found: DataFrame, kind: str) -> DataFrame:
        """A rule's (KEY, ref[, start, end][, direction]) for plain rows."""
        spans = found if "start" in found.columns else found.join(plain.select(*KEY, "start", "end"), KEY)
        wide = spans.withColumns({"sub": F.lit(0), "kind": F.lit(kind), "offered": F.lit(None).cast("string")})
        return wide.withColumns({k: v for k, v in none.items() if k not in wide.columns}).select(*ROW, "kind", "offered", "ref", "start", "end", "direction")

    each = plain.select(*ROW, F.explode("candidates").alias("ref"), "start", "end").distinct().withColumns({"kind": F.lit("candidate"), "offered": F.col("ref"), "direction": none["direction"]})
    given = rows.where("rebuilt").select(*ROW, F.col("given").alias("ref"), *own_span).withColumns({"kind": F.lit("given"), **none})
    found = []
    if works is not None and chapters is not None:
        # a pointing word is the source's own only where no writer and no other work govern it
        free = plain.where("writer is null")
        free = free.join(recover.names_elsewhere(free.where("own_title is not null"), works), KEY, "left_anti")
        found = [
            offered(recover.own_relative(free, segments), "own"),
            offered(recover.own_daf(plain, works, segments, chapters), "own_leaf"),
            offered(recover.parenthesized(plain, works, segments, chapters), "parenthesized"),
            offered(recover.chapter_led(plain, works, segments, chapters), "chapter"),
            offered(recover.geresh_verses(plain.where(~F.array_contains(labels(), "RELATIVE")), works, segments), "geresh"),
        ]
    if quoted is not None:
        found.append(offered(quoted.where("decides").select(*KEY, "ref"), "quoted"))
    out = each.select(*ROW, "kind", "offered", "ref", "start", "end", "direction").unionByName(given.select(*ROW, "kind", "offered", "ref", "start", "end", "direction"))
    for part in found:
        out = out.unionByName(part)
    return out


def checked(found: DataFrame, rows: DataFrame, segments: DataFrame, keep: Keep = again) -> DataFrame:
    """Options that pass all rules without history, with their final ref, span and direction.

    Each mend uses the ref several times, so what is kept between them is read instead of being written out in every use.
    """
    facts = rows.select(*ROW, "content", "parts", "candidates", "context", "place", "writer", "commentary")
    c = found.join(facts, ROW)
    kind, ref = F.col("kind"), F.col("ref")
    # a candidate keeps its pointing word's duties; what was rebuilt has met them by its own rule
    c = c.withColumn("relative", (kind == "candidate") & F.array_contains(labels(), "RELATIVE")).withColumn("anchor", anchor())
    c = c.where(~rules.is_line_marker(F.col("content"), F.col("end")) & (~F.col("relative") | ((F.size("candidates") == 1) & F.col("context").isNotNull() & F.col("place").isNotNull())))
    # a colon after a whole leaf means its second side, and belongs to the link
    leafed = segments.where(F.col("ref").rlike(" [0-9]+[ab](:|$)")).select(F.col("title").alias("l_title"), F.lit(True).alias("leafed")).distinct()
    c = c.join(leafed, rules.title_of(ref) == F.col("l_title"), "left")
    second = rules.marked_second_side(ref, F.col("content"), F.col("start"), F.col("end"), F.coalesce("leafed", F.lit(False)))
    c = c.withColumn("second", second).withColumn("ref", F.when(F.col("second").isNotNull(), F.concat("ref", F.lit("b"))).otherwise(ref)).withColumn("end", F.coalesce("second", "end"))
    c = keep(c.drop("l_title", "leafed", "second"))
    # an address that the anchor spells wins over another one, if it is the only one
    c = c.withColumn("ref", F.when(rules.address_contradicts(ref, F.col("anchor")), rules.spelled_ref(ref, F.col("anchor"))).otherwise(ref))
    c = keep(c)
    c = c.where(ref.isNotNull() & ~rules.implausible(ref, F.col("anchor")))
    # a writer who governs the citation, or may, is no evidence for the base text that a failed one was rebuilt to
    c = c.where(~kind.isin("given", "geresh") | ~ref.rlike(" [0-9]+[ab]$") | F.col("writer").isNull())
    # a note on a code by its own author and numbers takes the place of the code
    notes = recover.code_commentary(rows.where("not rebuilt"), segments).select(*KEY, F.col("ref").alias("note"))
    c = c.join(notes, KEY, "left").withColumn("noted", (kind == "candidate") & F.col("note").isNotNull())
    c = c.withColumn("ref", F.when(F.col("noted"), F.col("note")).otherwise(ref)).withColumn("kind", F.when(F.col("noted"), "note").otherwise(kind))
    c = keep(c)
    title = rules.title_of(ref)
    c = c.where(F.col("noted") | (~rules.base_code_note(title, F.col("anchor")) & ~rules.unproven_number(title, F.col("parts"))))
    known = segments.where("has_text").select("ref", F.col("title").alias("t_title"), F.col("place").alias("t_place"))
    c = c.join(known, "ref")
    same = F.coalesce(rules.title_of(F.col("context")) == F.col("t_title"), F.lit(False))
    side = rules.relative_direction(labels(), F.col("anchor"), same, F.col("place"), F.col("t_place"))
    c = c.withColumn("direction", F.when(F.col("relative") & ~F.col("noted"), side).otherwise(F.col("direction")))
    c = c.where(~F.col("relative") | F.col("noted") | F.col("direction").isNotNull())
    # a side of a leaf with a named commentary is shown as that commentary's, if it has text; history keeps the side itself
    side = F.regexp_extract(F.col("ref"), "^(.+ [0-9]+[ab])(?::[0-9:]+)?$", 1)
    upgrade = F.when(kind.isin("candidate", "own", "parenthesized", "chapter") & (side != ""), F.concat(F.col("commentary"), F.lit(" on "), side))
    notes = segments.where("has_text").select(F.explode(F.array_distinct(F.array(F.col("ref"), F.regexp_replace("ref", ":[0-9:]+$", "")))).alias("shown")).where(F.col("shown").rlike("^(?:Rashi|Tosafot) on ")).distinct()
    c = c.withColumn("upgrade", upgrade).join(notes, F.col("upgrade") == F.col("shown"), "left")
    return c.withColumn("direction", F.when(F.col("shown").isNull(), F.col("direction"))).select(*ROW, "kind", "offered", "ref", "start", "end", "direction", "shown")


def continuations(rows: DataFrame, segments: DataFrame, found: DataFrame, quoted: DataFrame | None = None, by: list[str] = BOOK) -> DataFrame:
    """(ROW, address, homes, verse, evidence): what "there" with printed numbers of its own needs, wherever it turns out to point.

    homes: titles that the book's own options name and that have text at the printed leaf; without `by`, those that any option names.
    """
    plain = recover.part_text(F.struct(text.bare(anchor()).alias("text")))
    there = rows.where("not rebuilt").where(F.array_contains(labels(), "IBID") & ~F.arrays_overlap(labels(), F.array(F.lit("NAMED"), F.lit("RELATIVE"))))
    c = there.withColumn("plain", F.btrim(plain, F.lit(" ()[]")))
    leaf = addresses.daf_address(F.regexp_replace("plain", "^(?:שם|התם),? ", ""))
    c = c.withColumn("leaf", F.when(F.col("plain").rlike("^(?:שם|התם),? "), leaf))
    c = c.withColumn("address", F.when(F.col("leaf").isNotNull(), F.concat(F.col("leaf.daf").cast("string"), F.col("leaf.side"))))
    verses = quotes.printed(there).where((F.col("theres") < 2) | (F.size("numbers") == 1)).select(*ROW, F.col("numbers").alias("verse"))
    c = c.join(verses, ROW, "left").withColumn("verse", F.when(F.col("address").isNull(), F.col("verse")))
    titles = found.select(*by, rules.title_of(F.col("ref")).alias("work")).distinct()
    asked = c.where("address is not null").select(*ROW, "address")
    have = segments.where("has_text").select(F.col("title").alias("work"), F.regexp_extract("ref", " ([0-9]+[ab])(?::[0-9:]+)?$", 1).alias("address")).where("address <> ''").distinct()
    met = asked.join(titles, by).join(have, ["work", "address"]) if by else asked.join(have.join(titles, "work"), "address")
    homes = met.groupBy(*ROW).agg(F.sort_array(F.collect_set("work")).alias("homes"))
    out = c.select(*ROW, "address", "verse").join(homes, ROW, "left")
    if quoted is None:
        return out.withColumn("evidence", F.array().cast("array<string>"))
    evidence = quoted.groupBy(*KEY).agg(F.sort_array(F.collect_set("ref")).alias("evidence"))
    return out.join(evidence, KEY, "left")


def prepared(rows: DataFrame, good: DataFrame, more: DataFrame) -> DataFrame:
    """A row for each entry as `step` takes it."""
    o = F.struct("kind", "offered", "ref", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "direction", "shown")
    outcomes = good.groupBy(*ROW).agg(F.sort_array(F.collect_list(o)).alias("outcomes"))
    own = F.col("context_type").eqNullSafe("CURRENT_BOOK")
    empty = lambda kind: F.array().cast(kind)
    # a list of verses that failed keeps no candidates, so `rebuilt` alone says that it isn't a failure
    base = rows.select(*ROW, labels().alias("labels"), F.when(F.col("rebuilt"), empty("array<string>")).otherwise(F.col("candidates")).alias("candidates"), "rebuilt", "resets", own.alias("own_context"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    wide = base.join(outcomes, ROW, "left").join(more, ROW, "left")
    return wide.withColumns({"outcomes": F.coalesce("outcomes", empty(f"array<{OPTION}>")), "homes": F.coalesce("homes", empty("array<string>")), "verse": F.coalesce("verse", empty("array<int>")), "evidence": F.coalesce("evidence", empty("array<string>"))})


def _objects(column: pa.Array) -> list:
    """`to_pylist`, by whole columns instead of value by value."""
    kind = column.type
    if pa.types.is_struct(kind) and not column.null_count:
        names = [kind.field(k).name for k in range(kind.num_fields)]
        return [dict(zip(names, v, strict=True)) for v in zip(*map(_objects, column.flatten()), strict=True)]
    if pa.types.is_list(kind) and not column.null_count:
        flat, at = _objects(column.flatten()), column.offsets.to_numpy()
        at = (at - at[0]).tolist()
        return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    if pa.types.is_string(kind) or not column.null_count and (pa.types.is_integer(kind) or pa.types.is_boolean(kind)):
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def _records(batch: pa.RecordBatch) -> Iterator[dict]:
    names = batch.schema.names
    return (dict(zip(names, v, strict=True)) for v in zip(*map(_objects, batch.columns), strict=True))


FOLDED = "source string, title string, line_index int, pos int, sub int, kind string, ref string, start int, end int, direction string, shown string"
TAKEN = ("kind", "ref", "start", "end", "direction", "shown")


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(f.split()[0], pa.int32() if f.endswith("int") else pa.string()) for f in fields.split(", ")])


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def folded(rows: DataFrame) -> DataFrame:
    """(ROW, kind, ref, start, end, direction, shown) of the citations that get a target, folded in the order of their books.

    A partition's rows are streamed; one history is held, not a book.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, history = None, History()
        for batch in batches:
            out = []
            for row in _records(batch):
                if (row["source"], row["title"]) != now:
                    now, history = (row["source"], row["title"]), History()
                history, taken = step(history, row)
                if taken is not None:
                    out.append([row[k] for k in ROW] + [taken[k] for k in TAKEN])
            yield _batch(out, schema)

    schema = _schema(FOLDED)
    ordered = rows.withColumns({k: F.col(k).cast("int") for k in ("line_index", "pos", "sub")}).repartition(*BOOK).sortWithinPartitions(*ROW)
    return ordered.mapInArrow(run, FOLDED)


def kinds_of(citations: DataFrame, keep: Keep) -> tuple[DataFrame, DataFrame] | None:
    """Lines (LINE, said) and kinds (line_kind, said) of complete citations; None if there are too many kinds for them to be worth it.

    said: all citations of a line with every column but the line's place, in order; lines of a kind are equal in all of them.
    """
    each = F.struct("pos", *[c for c in citations.columns if c not in KEY])
    # citations are keyed by line and pos: where pos is always the same no line has two, and lines needn't be put together
    apart = keep(citations.select(F.array(each).alias("said")).distinct().limit(KINDS + 1))
    n, positions = apart.agg(F.count("*"), F.count_distinct(F.col("said")[0]["pos"])).first()
    if not 0 < n <= KINDS:
        return None
    if positions == 1:
        lines, said = citations.select(*LINE, F.array(each).alias("said")), apart
    else:
        lines = keep(citations.groupBy(*LINE).agg(F.sort_array(F.collect_list(each)).alias("said")))
        said = lines.select("said").distinct().limit(KINDS + 1)
    kinds = keep(said.withColumn("line_kind", F.monotonically_increasing_id()))
    n, size = kinds.agg(F.count("*"), F.sum(F.length(F.to_json("said")))).first()
    return (lines, kinds) if n <= KINDS and size <= KIND_CHARS and n * REPEATED <= lines.count() else None


def of_kinds(kinds: DataFrame, segments: DataFrame, works: DataFrame | None, chapters: DataFrame | None, keep: Keep) -> DataFrame | None:
    """(line_kind, entries): the rows of each kind of line as `step` takes them, in order. None where homes would depend on the book.

    Each kind is a book of one line. Homes are then the titles that any book names: a book can only ask for one that its own options
    name, unless a mend has changed an option's title, so no title of a mended option may be among them.
    """
    alone = {"source": F.lit(""), "title": F.col("line_kind").cast("string"), "line_index": F.lit(0)}
    c = kinds.withColumns(alone).select(*LINE, F.explode("said").alias("c")).select(*LINE, "c.*")
    rows = keep(entries(c, segments, works, chapters, keep))
    found = keep(options(rows, segments, works, chapters))
    good = keep(checked(found, rows, segments, keep))
    more = keep(continuations(rows, segments, found, by=[]))
    ref = F.col("ref")
    named = found.select("title", rules.title_of(ref).alias("work")).distinct()
    mended = good.select("title", F.explode(F.array(ref, F.regexp_replace(ref, " [^ ]*$", ""))).alias("work")).distinct().join(named, ["title", "work"], "left_anti")
    if not more.select(F.explode("homes").alias("work")).join(mended, "work", "left_semi").isEmpty():
        return None
    ready = prepared(rows, good, more)
    row = F.struct(*[F.col(k).cast("int").alias(k) for k in ROW[3:]], *[k for k in ready.columns if k not in ROW])
    by_kind = keep(ready.groupBy("title").agg(F.sort_array(F.collect_list(row)).alias("entries")).select(F.col("title").cast("long").alias("line_kind"), "entries"))
    size = by_kind.agg(F.sum(F.length(F.to_json("entries")))).first()[0]
    return by_kind if size <= 4 * KIND_CHARS else None


def _line(history: History, rows: list[dict]) -> tuple[History, list[tuple]]:
    """The history after a line's rows, and (pos, sub, TAKEN) of those that get a target."""
    out = []
    for row in rows:
        history, taken = step(history, row)
        if taken is not None:
            out.append((row["pos"], row["sub"], *[taken[k] for k in TAKEN]))
    return history, out


def folded_kinds(lines: DataFrame, kinds: DataFrame, by_kind: DataFrame) -> DataFrame:
    """`folded` for lines and the rows of their kinds, with line_kind. Only a line's number moves; a task reads a kind's rows when it first meets it."""
    table = by_kind.toArrow().combine_chunks()
    at = dict(zip(table["line_kind"].to_pylist(), range(len(table)), strict=True))
    known = table["entries"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, history = None, History()
        read: dict[int, list[dict]] = {}
        after: dict[tuple[History, int], tuple[History, list[tuple]]] = {}
        for batch in batches:
            out = []
            for source, title, line_index, kind in zip(*map(_objects, batch.columns), strict=True):
                if (source, title) != now:
                    now, history = (source, title), History()
                if (history, kind) not in after:
                    if len(after) >= REMEMBERED:
                        after.clear()
                    if kind not in read:
                        read[kind] = known[at[kind]].as_py()
                    after[history, kind] = _line(history, read[kind])
                history, found = after[history, kind]
                out.extend((source, title, line_index, *t, kind) for t in found)
            yield _batch(out, schema)

    schema = _schema(FOLDED).append(pa.field("line_kind", pa.int64()))
    ordered = lines.join(F.broadcast(kinds), "said").select(*LINE, "line_kind").withColumn("line_index", F.col("line_index").cast("int")).repartition(*BOOK).sortWithinPartitions(*LINE)
    return ordered.mapInArrow(run, f"{FOLDED}, line_kind long")


WORKS, CHAPTERS = "title string, aliases array<string>, category string", "title string, name string, first int, last int"
_OPTIONAL = {"own_title": "string", "own_he": "string", "section": "int", "section_last": "int", "context_type": "string"}


def complete(citations: DataFrame) -> DataFrame:
    """With the optional columns, and with spans of parts, null where they aren't known."""
    part = citations.schema["parts"].dataType.elementType.names
    spans = [F.lit(None).cast("int").alias(x) for x in ("start", "end") if x not in part]
    out = citations.withColumn("parts", F.transform("parts", lambda p: F.struct(*[p[x].alias(x) for x in part], *spans)))
    return out.withColumns({c: F.lit(None).cast(kind) for c, kind in _OPTIONAL.items() if c not in citations.columns})


def resolved(citations: DataFrame, segments: DataFrame, works: DataFrame | None = None, chapters: DataFrame | None = None, quoted: DataFrame | None = None, keep: Keep = again) -> DataFrame:
    """`folded` for citations and catalogs; quoted: (KEY, ref, decides) of `quotes.evidence`, which belong to single lines.

    keep: what to do with tables that several rules read, such as writing them; by default they are computed again, and no kinds are looked for.
    """
    return _resolved(citations, segments, works, chapters, quoted, keep)[0].drop("line_kind")


def _resolved(citations: DataFrame, segments: DataFrame, works: DataFrame | None, chapters: DataFrame | None, quoted: DataFrame | None, keep: Keep) -> tuple[DataFrame, DataFrame | None]:
    """`resolved`, and the kinds of lines if it goes by them."""
    lines_and_kinds = kinds_of(complete(citations), keep) if quoted is None and keep is not again else None
    if lines_and_kinds is not None:
        lines, kinds = lines_and_kinds
        by_kind = of_kinds(kinds, segments, works, chapters, keep)
        if by_kind is not None:
            return folded_kinds(lines, kinds, by_kind), kinds
    rows = keep(entries(complete(citations), segments, works, chapters, keep))
    found = keep(options(rows, segments, works, chapters, quoted))
    good = keep(checked(found, rows, segments, keep))
    return folded(prepared(rows, good, continuations(rows, segments, found, quoted))), None


def resolve(citations: DataFrame, segments: DataFrame, works: DataFrame | None = None, chapters: DataFrame | None = None, quoted: DataFrame | None = None, keep: Keep = again) -> DataFrame:
    """LINKS of citations."""
    taken, kinds = _resolved(citations, segments, works, chapters, quoted, keep)
    if kinds is None:
        return links(taken, citations)
    said = kinds.select("line_kind", F.explode("said").alias("c")).select("line_kind", "c.pos", "c.content", "c.context")
    return _links(taken.join(F.broadcast(said), ["line_kind", "pos"]))


def links(taken: DataFrame, citations: DataFrame) -> DataFrame:
    """LINKS of folded rows, to what is shown for a target where that differs, offsets in UTF-16; only a pointing link carries the line's own context."""
    return _links(taken.join(citations.select(*KEY, "content", "context"), KEY))


def _links(c: DataFrame) -> DataFrame:
    at = {x: text.utf16_offset(F.col("content"), F.col(x)) for x in ("start", "end")}
    cols: dict[str, Column] = {
        "line_index_base": F.lit(0),
        **at,
        "target_ref": F.coalesce("shown", "ref"),
        "source_path": F.lit(None),
        "source_hash": content_hash(F.col("content")),
        "context_ref": F.when(F.col("direction").isNotNull(), F.col("context")),
        "relative_direction": F.col("direction"),
    }
    return c.select(*LINE, *[v.cast(LINKS[k].dataType).alias(k) for k, v in cols.items()])
