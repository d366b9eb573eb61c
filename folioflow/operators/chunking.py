"""Chunking: ordered structural items to typed chunks and relationship edges.

Everything is keyed by doc_id: items are ordered by one window per document, runs are
found by flags that change, and only the greedy packing of a run's blocks is a fold,
over an array as long as the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import ChunkRules
from folioflow.functions.text import NUMBERED, REFERENCES, collapse, count_tokens, section_number, short_hash
from folioflow.sources.sinks import dealt

#: Tables and figures come after text at the same place.
LATE = 10_000
#: What items are read in the order of; ``ord`` numbers it.
READING = ("page_number", "y0", "x0", "reading_order", "kind", "block_id")


def items(blocks: DataFrame, tables: DataFrame, figures: DataFrame, headings: tuple[str, ...] = ("heading",), tasks: int = 0) -> DataFrame:
    """All structural items in reading order, with their role and number ``ord`` in the document; ``tasks`` as in ``sinks.dealt``."""
    text = blocks.select("doc_id", "block_id", "page_number", "y0", "x0", box(blocks), "reading_order", "block_type", "text").withColumn("kind", F.lit(0))
    place = lambda df, key, kind, *more: df.select("doc_id", F.col(key).alias("block_id"), "page_number", "y0", "x0", box(df), F.lit(LATE).alias("reading_order"), "caption", F.lit(kind).alias("kind"), *more)
    every = text.unionByName(place(tables, "table_id", 1), allowMissingColumns=True).unionByName(place(figures, "figure_id", 2, "figure_type"), allowMissingColumns=True)
    order = Window.partitionBy("doc_id").orderBy(*READING)
    role = (
        F.when(F.col("kind") == 1, "table")
        .when(F.col("kind") == 2, "figure")
        .when(F.col("block_type").isin(*headings), "heading")
        .when((F.col("block_type") == "list_item") & F.col("text").rlike(NUMBERED), "numbered")
        .otherwise("text")
    )
    return dealt(every, tasks, "doc_id").withColumn("ord", F.row_number().over(order)).withColumn("role", role)


def box(df: DataFrame) -> Column:
    """The bounding box of items, from x0, y0, x1 and y1; sides that are not known end where they begin."""
    side = lambda c, other: F.col(c if c in df.columns else other).cast("double").alias(c)
    return F.struct(side("x0", "x0"), side("y0", "y0"), side("x1", "x0"), side("y1", "y0")).alias("box")


def box_union(boxes: Column) -> Column:
    """The smallest box around an array of boxes."""
    ends = lambda c, f: f(F.transform(boxes, lambda b: b[c])).alias(c)
    return F.struct(ends("x0", F.array_min), ends("y0", F.array_min), ends("x1", F.array_max), ends("y1", F.array_max))


def sections(ordered: DataFrame, order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Adds the active section (the last heading so far; none for headings themselves).

    Right after ``items``, with the order ``READING``, rows need not be sorted again.
    """
    so_far = Window.partitionBy("doc_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    heading = F.col("role") == "heading"
    return ordered.withColumn("section", F.when(~heading, F.last(F.when(heading, F.trim("text")), ignorenulls=True).over(so_far))).withColumn(
        "section_ord", F.when(~heading, F.last(F.when(heading, F.col("ord")), ignorenulls=True).over(so_far))
    )


def runs(ordered: DataFrame, order: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Adds ``run``: maximal runs of plain text or of numbered items; other items stand alone. ``order`` as in ``sections``."""
    w = Window.partitionBy("doc_id").orderBy(*order)
    joins = F.col("role").isin("text", "numbered") & (F.lag("role").over(w) == F.col("role"))
    return ordered.withColumn("begins", F.when(joins, 0).otherwise(1)).withColumn("run", F.sum("begins").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("begins")


#: Blocks that one inner fold numbers.
STRETCH = 256


def pack_numbers(tokens: Column, limit: Column | int) -> Column:
    """The number, from 1, of every block's pack, from an array of their tokens in order.

    A pack takes blocks while their tokens sum to at most ``limit``; a block that is larger
    stands alone. As a fold copies what it has gathered at each step, stretches of blocks are
    folded by themselves, from the sum and the pack that the one before has ended with.
    """

    def block(acc: Column, x: Column) -> Column:
        new = (acc["pack"] == 0) | (acc["sum"] + x > limit)
        pack = acc["pack"] + F.when(new, 1).otherwise(0)
        return F.struct(F.when(new, x).otherwise(acc["sum"] + x).cast("long").alias("sum"), pack.alias("pack"), F.array_append(acc["own"], pack).alias("own"))

    def stretch(acc: Column, k: Column) -> Column:
        begin = F.struct(acc["sum"].alias("sum"), acc["pack"].alias("pack"), F.array().cast("array<int>").alias("own"))
        folded = F.aggregate(F.slice(tokens, k * STRETCH + 1, F.lit(STRETCH)), begin, block)
        joined = lambda f: F.struct(f["sum"].alias("sum"), f["pack"].alias("pack"), F.array_append(acc["all"], f["own"]).alias("all"))
        # Through an array, so that the stretch is folded once.
        return F.get(F.transform(F.array(folded), joined), F.lit(0))

    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("pack"), F.array().cast("array<array<int>>").alias("all"))
    stretches = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(tokens) / STRETCH).cast("int") - 1), F.lit(1))
    return F.aggregate(stretches, zero, stretch, lambda acc: F.flatten(acc["all"]))


def packs(members: Column, limit: Column | int) -> Column:
    """First ``ord`` of every pack of an array of struct(ord, tokens) in order."""
    numbers = pack_numbers(F.transform(members, lambda m: m["tokens"]), limit)
    first = lambda n: F.filter(members, lambda m, i: (i == 0) | (F.get(n, i) != F.get(n, i - 1)))
    return F.transform(F.flatten(F.transform(F.array(numbers), first)), lambda m: m["ord"])


def packed(run_rows: DataFrame, rules: ChunkRules = ChunkRules(), tasks: int = 0) -> DataFrame:
    """Packs of text and numbered runs: doc_id, run, role, part, parts, first ord, content, pages, tokens.

    A run that fits into one pack is one. Of others, a fold numbers the packs; their blocks then go
    on by themselves and gather by pack, in the task that has the run, so the work is in proportion
    to its length.
    """
    rows = run_rows.where(F.col("role").isin("text", "numbered")).withColumn("tokens", count_tokens(F.col("text")))
    run = dealt(rows, tasks, "doc_id", "run").groupBy("doc_id", "run").agg(
        F.first("role").alias("role"), F.first("section").alias("section"), F.first("section_ord").alias("section_ord"), F.array_sort(F.collect_list(F.struct("ord", "tokens", "text", "page_number", "box"))).alias("blocks")
    )
    limit = F.when(F.col("role") == "text", rules.chunk_tokens).otherwise(rules.list_tokens)
    total = lambda blocks: F.aggregate(F.transform(blocks, lambda b: b["tokens"].cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    fits = total("blocks") <= limit
    run = run.withColumn("packs", F.when(~fits, pack_numbers(F.transform("blocks", lambda b: b["tokens"]), limit)))
    run = run.withColumn("parts", F.coalesce(F.element_at("packs", -1), F.lit(1)))
    apart = F.transform(F.arrays_zip("blocks", "packs"), lambda z: F.struct(z["packs"].alias("part"), F.array(z["blocks"]).alias("blocks")))
    pieces = F.when(F.col("packs").isNull(), F.array(F.struct(F.lit(1).alias("part"), F.col("blocks")))).otherwise(apart)
    piece = run.select("doc_id", "run", "role", "section", "section_ord", "parts", F.explode(pieces).alias("b"))
    pack = piece.groupBy("doc_id", "run", F.col("b.part").alias("part")).agg(*[F.first(c).alias(c) for c in ("role", "section", "section_ord", "parts")], F.array_sort(F.flatten(F.collect_list("b.blocks"))).alias("own"))
    return pack.select(
        "doc_id",
        "run",
        "role",
        "section",
        "section_ord",
        "part",
        "parts",
        F.get("own", F.lit(0))["ord"].alias("ord"),
        F.array_join(F.transform("own", lambda b: b["text"]), "\n").alias("content"),
        F.array_sort(F.array_distinct(F.transform("own", lambda b: b["page_number"]))).alias("pages"),
        F.size("own").alias("n_blocks"),
        # Packs are lines, and no token goes over the end of one.
        total("own").cast("int").alias("tokens"),
        box_union(F.transform("own", lambda b: b["box"])).alias("box"),
    )


def table_parts(tables: DataFrame, cells: DataFrame, limit: int = 20, tasks: int = 0) -> DataFrame:
    """Tables cut into groups of ``limit`` rows, each with the header line.

    ``tables`` has doc_id, table_id, headers; ``cells`` has doc_id, table_id, i and the
    row's cells. A table without rows is one part. Groups are keyed by row number, so a
    long table needs no array of all its rows.
    """
    parts = dealt(cells.withColumn("part", F.floor((F.col("i") - 1) / limit) + 1), tasks, "doc_id").groupBy("doc_id", "table_id", "part").agg(
        F.array_sort(F.collect_list(F.struct("i", F.array_join("cells", " | ").alias("line")))).alias("rows")
    )
    counts = parts.groupBy("doc_id", "table_id").agg(F.count("*").alias("parts"))
    known = dealt(tables, tasks, "doc_id").join(counts, ["doc_id", "table_id"], "left").join(parts, ["doc_id", "table_id"], "left")
    lines = F.concat(F.array(F.array_join("headers", " | ")), F.coalesce(F.transform("rows", lambda r: r["line"]), F.array().cast("array<string>")))
    # As if stripped: a table without headers begins with its first row.
    content = F.trim(F.regexp_replace(F.array_join(lines, "\n"), r"^\s+|\s+$", ""))
    return known.select(
        "doc_id", "table_id", "headers", F.coalesce("part", F.lit(1)).cast("int").alias("part"), F.coalesce("parts", F.lit(1)).cast("int").alias("parts"), F.coalesce(F.size("rows"), F.lit(0)).alias("row_count"), content.alias("content")
    )


def chunks(blocks: DataFrame, tables: DataFrame, cells: DataFrame, figures: DataFrame, rules: ChunkRules = ChunkRules(), ordered: DataFrame | None = None, tasks: int = 0) -> DataFrame:
    """All chunks: doc_id, n, chunk_id, chunk_type, content, pages, box, section, labels, tokens and hash.

    The items in order feed four kinds of chunks; hand them over as ``ordered``, with
    their runs, where they are stored already. Tables without headers and rows are dropped.
    """
    ordered = runs(sections(items(blocks, tables, figures, rules.headings, tasks))) if ordered is None else ordered
    columns = ["doc_id", "ord", "part", "parts", "chunk_type", "content", "pages", "box", "section", "section_ord"]
    one = lambda df: df.withColumn("part", F.lit(1)).withColumn("parts", F.lit(1)).withColumn("pages", F.array("page_number"))
    head = one(ordered.where("role = 'heading'")).withColumn("chunk_type", F.lit("section_header")).withColumn("content", F.col("text"))
    head = head.withColumn("label", F.concat(F.lit("Section "), section_number(F.col("text"))))
    text = packed(ordered, rules, tasks)
    kind = F.when(F.col("role") == "text", "section_text").when(F.col("parts") > 1, "list_segment").otherwise("numbered_list")
    text = text.withColumn("chunk_type", kind).withColumn("list_items", F.when(F.col("role") == "numbered", F.col("n_blocks")))
    nth = Window.partitionBy("doc_id", "role").orderBy("ord")
    placed = dealt(ordered.where(F.col("role").isin("table", "figure")), tasks, "doc_id").withColumn("nth", F.row_number().over(nth))
    table = placed.where("role = 'table'").select("doc_id", F.col("block_id").alias("table_id"), "ord", "page_number", "box", "section", "section_ord", "nth")
    table = table.join(with_content(table_parts(tables, cells, rules.table_rows, tasks)), ["doc_id", "table_id"]).withColumn("pages", F.array("page_number"))
    table = table.withColumn("chunk_type", F.when(F.col("parts") > 1, "table_segment").otherwise("table")).withColumn("label", F.concat(F.lit("Table "), F.col("nth")))
    figure = one(placed.where("role = 'figure'"))
    caption = F.nullif(F.trim(F.coalesce("caption", F.lit(""))), F.lit(""))
    figure = figure.withColumn("content", F.coalesce(caption, F.concat(F.lit("[Figure: "), F.col("figure_type"), F.lit("]")))).withColumn("chunk_type", F.lit("figure"))
    figure = figure.withColumn("label", F.concat(F.lit("Figure "), F.col("nth")))
    pick = lambda df, *more: df.select(*columns, *more)
    made = (
        pick(head, "label")
        .unionByName(pick(text, "list_items", "tokens"), allowMissingColumns=True)
        .unionByName(pick(table, "label", "headers", "row_count"), allowMissingColumns=True)
        .unionByName(pick(figure, "label", "caption"), allowMissingColumns=True)
    )
    order = Window.partitionBy("doc_id").orderBy("ord", "part")
    made = dealt(made, tasks, "doc_id").withColumn("n", F.row_number().over(order))
    made = made.withColumn("chunk_id", F.format_string("%s-%s-%04d", F.col("doc_id"), F.col("chunk_type"), F.col("n")))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    header = F.last(F.when(F.col("chunk_type") == "section_header", F.col("chunk_id")), ignorenulls=True).over(so_far)
    made = made.withColumn("section_chunk", F.when(F.col("chunk_type") != "section_header", header)).withColumn("previous", F.lag("chunk_id").over(order))
    return made.withColumn("tokens", F.coalesce("tokens", count_tokens(F.col("content")))).withColumn("content_hash", chunk_hash())


def with_content(parts: DataFrame) -> DataFrame:
    """Parts of tables that have headers or rows."""
    return parts.where((F.coalesce(F.size("headers"), F.lit(0)) > 0) | (F.col("row_count") > 0))


def chunk_hash() -> Column:
    """SHA-256 over collapsed content, type, pages and section, so white space does not matter."""
    pages = F.array_join(F.col("pages").cast("array<string>"), ",")
    return F.sha2(F.concat_ws("|", collapse(F.col("content")), "chunk_type", pages, F.coalesce("section", F.lit(""))), 256)


def structural_edges(made: DataFrame) -> DataFrame:
    """belongs_to_section and follows edges; section headers have none of their own."""
    rows = made.where("chunk_type <> 'section_header'")
    belongs = rows.where("section_chunk is not null").select("doc_id", "chunk_id", F.lit("belongs_to_section").alias("edge_type"), F.col("section_chunk").alias("target"), F.col("section").alias("label"))
    follows = rows.where("previous is not null").select("doc_id", "chunk_id", F.lit("follows").alias("edge_type"), F.col("previous").alias("target"), F.col("previous").alias("label"))
    return belongs.unionByName(follows).withColumn("resolved", F.lit(True))


def reference_edges(made: DataFrame) -> DataFrame:
    """References in the chunks' text to tables, figures and sections; unknown labels stay unresolved."""
    found = []
    for kind, pattern in REFERENCES.items():
        # Where a match begins: behind the pieces between matches, and the matches, before it.
        whole, pieces = F.regexp_extract_all("content", F.lit(pattern), F.lit(0)), F.split("content", pattern)
        lengths = lambda a, n: F.aggregate(F.slice(a, F.lit(1), n), F.lit(0), lambda s, x: s + F.length(x))
        numbers = F.regexp_extract_all("content", F.lit(pattern), F.lit(1))
        hits = F.transform(numbers, lambda x, i: F.struct(x.alias("number"), (lengths(pieces, i + 1) + lengths(whole, i)).alias("offset")))
        rows = made.where(F.col("content").rlike(pattern)).select("doc_id", "chunk_id", F.explode(hits).alias("hit")).select("doc_id", "chunk_id", "hit.number", "hit.offset")
        found.append(rows.withColumn("edge_type", F.lit(f"references_{kind}")).withColumn("label", F.concat(F.lit(f"{kind.title()} "), F.col("number"))))
    references = found[0].unionByName(found[1]).unionByName(found[2])
    # The first chunk that carries a label is the target.
    labels = made.where("label is not null").groupBy("doc_id", "label").agg(F.min_by("chunk_id", "n").alias("target"))
    edges = references.join(labels, ["doc_id", "label"], "left")
    edge_id = F.concat(F.lit("rel-"), short_hash(12, F.col("chunk_id"), F.col("edge_type"), F.col("label"), F.col("offset").cast("string")))
    return edges.select("doc_id", "chunk_id", "edge_type", "target", "label", F.col("target").isNotNull().alias("resolved"), edge_id.alias("edge_id"))
