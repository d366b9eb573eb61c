"""Section trees: parents, paths, page ranges, entities, data types and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.config import IndexRules
from folioflow.functions.text import parent_number, section_number, short_hash
from folioflow.sources.sinks import dealt, shuffled, written

#: What a chunk type counts as in a section.
DATA_TYPES = {
    "section_header": "narrative_text",
    "section_text": "narrative_text",
    "table": "tables",
    "table_segment": "tables",
    "figure": "figures",
    "numbered_list": "lists",
    "list_segment": "lists",
}
#: What counts as an entity.
TITLE_ENTITY = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+\b"
IDENTIFIER = r"\b[A-Z]{2,}[A-Z0-9\-]{1,}\b"


def headers(chunks: DataFrame, tasks: int = 0) -> DataFrame:
    """Titles of each document with number and parent title, ordered by page and chunk.

    The parent is the latest header before it whose number is the title's number less
    its last part. A title that occurs again keeps its first place and takes the last
    one's parent. ``tasks`` as in ``sinks.dealt``, here and below.
    """
    heads = chunks.where("chunk_type = 'section_header'").select("doc_id", F.array_min("pages").alias("page"), "chunk_id", F.trim("content").alias("title"))
    order = Window.partitionBy("doc_id").orderBy("page", "chunk_id")
    heads = dealt(heads, tasks, "doc_id").withColumn("h", F.row_number().over(order)).withColumn("number", section_number(F.col("title"))).withColumn("parent_number", parent_number(F.col("number")))
    earlier = heads.select("doc_id", F.col("number").alias("parent_number"), F.col("h").alias("p_h"), F.col("title").alias("p_title")).where("parent_number is not null")
    below = heads.select("doc_id", "h", "parent_number").where("parent_number is not null")
    pairs = dealt(below, tasks, "doc_id", "parent_number").join(dealt(earlier, tasks, "doc_id", "parent_number"), ["doc_id", "parent_number"]).where("p_h < h")
    parents = dealt(pairs, tasks, "doc_id", "h").groupBy("doc_id", "h").agg(F.max_by("p_title", "p_h").alias("parent"))
    known = dealt(heads, tasks, "doc_id", "h").join(parents, ["doc_id", "h"], "left")
    return dealt(known, tasks, "doc_id", "title").groupBy("doc_id", "title").agg(F.min("h").alias("h"), F.max_by("parent", "h").alias("parent"), F.max_by("number", "h").alias("number"))


#: Title of the one section of a document without headers. Fixed value.
WHOLE = "Document"


def tree(heads: DataFrame, chunks: DataFrame | None = None, tasks: int = 0) -> DataFrame:
    """One row per section: path, depth, id and ``key``; documents of ``chunks`` without headers have one root.

    The trees of all documents grow a level a step, as deep as the section numbers can
    be. Levels are written, so a step only joins the level before. ``key`` is what the
    section's chunks name: its title, or nothing for the root of a document without headers.
    """
    heads = written(heads, "heads", many=True)
    place = F.lpad(F.col("h").cast("string"), 9, "0")
    level = heads.where("parent is null").select("doc_id", "title", "h", "number", F.lit(None).cast("string").alias("parent"), F.col("title").alias("path"), F.lit(None).cast("string").alias("parent_path"), place.alias("sort_path"), F.lit(1).alias("depth"), F.col("title").alias("key"))
    if chunks is not None:
        ids = lambda df: dealt(df.select("doc_id"), tasks, "doc_id").distinct()
        bare = ids(chunks).join(ids(heads), "doc_id", "left_anti")
        whole, none = F.lit(WHOLE), F.lit(None).cast("string")
        level = level.unionByName(bare.select("doc_id", whole.alias("title"), F.lit(1).alias("h"), none.alias("number"), none.alias("parent"), whole.alias("path"), none.alias("parent_path"), F.lpad(F.lit("1"), 9, "0").alias("sort_path"), F.lit(1).alias("depth"), F.lit("").alias("key")))
    every = level = written(level, "sections", many=True)
    children = heads.where("parent is not null")
    for _ in range((children.agg(F.max(F.size(F.split("number", r"\.")))).first()[0] or 1) - 1):
        c, w = dealt(children, tasks, "doc_id", "parent").alias("c"), dealt(level, tasks, "doc_id", "title").alias("w")
        below = c.join(w, (F.col("c.doc_id") == F.col("w.doc_id")) & (F.col("c.parent") == F.col("w.title"))).select(
            "c.doc_id", "c.title", "c.h", "c.number", F.col("w.title").alias("parent"), F.concat("w.path", F.lit(" > "), "c.title").alias("path"), F.col("w.path").alias("parent_path"), F.concat("w.sort_path", F.lit("/"), F.lpad(F.col("c.h").cast("string"), 9, "0")).alias("sort_path"), (F.col("w.depth") + 1).alias("depth"), F.col("c.title").alias("key")
        )
        level = written(below, "sections", many=True)
        every = every.unionByName(level)
    own = F.concat("doc_id", F.lit("-section-"), short_hash(12, F.col("doc_id"), F.col("path")))
    above = F.when(F.col("parent_path").isNotNull(), F.concat("doc_id", F.lit("-section-"), short_hash(12, F.col("doc_id"), F.col("parent_path"))))
    return shuffled(every.withColumn("section_id", own).withColumn("parent_id", above))


def members(sections: DataFrame, chunks: DataFrame, tasks: int = 0) -> DataFrame:
    """(doc_id, section_id, chunk columns, direct): every section's chunks, and those of sections below it.

    A chunk belongs to the section of its title, all chunks of a document without headers
    to its root; other chunks without a known section drop out.
    """
    key = F.when(F.col("chunk_type") == "section_header", F.trim("content")).otherwise(F.coalesce("section", F.lit("")))
    known = dealt(sections.select("doc_id", "key", "sort_path"), tasks, "doc_id", "key")
    own = dealt(chunks.withColumn("key", key), tasks, "doc_id", "key").join(known, ["doc_id", "key"])
    # A section holds what lies at or under its path: as many rows as a path has parts.
    parts = F.split("sort_path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    spread = own.withColumn("at", F.explode(above)).withColumn("direct", F.col("at") == F.col("sort_path")).drop("key")
    target = sections.select("doc_id", F.col("sort_path").alias("at"), "section_id", F.col("title").alias("section_title"))
    return dealt(spread, tasks, "doc_id", "at").join(dealt(target, tasks, "doc_id", "at"), ["doc_id", "at"])


def ranges(sections: DataFrame, belonging: DataFrame, tasks: int = 0) -> DataFrame:
    """Page range and chunk count of every section, its descendants included."""
    key = ("doc_id", "section_id")
    spans = dealt(belonging.select(*key, "pages", "direct"), tasks, *key).groupBy(*key).agg(
        F.min(F.array_min("pages")).alias("page_start"), F.max(F.array_max("pages")).alias("page_end"), F.count("*").alias("n_chunks"), F.count_if("direct").alias("n_direct")
    )
    return dealt(sections, tasks, *key).join(spans, [*key], "left")


def chunk_lists(belonging: DataFrame) -> DataFrame:
    """Chunk ids of every section: its own first, then those below, depth first."""
    rows = F.array_sort(F.collect_list(F.struct("sort_path", "n", "chunk_id")))
    return belonging.groupBy("doc_id", "section_id").agg(F.transform(rows, lambda r: r["chunk_id"]).alias("chunk_ids"))


def entities(belonging: DataFrame, rules: IndexRules = IndexRules(), tasks: int = 0) -> DataFrame:
    """The best-scored entities of every section: title-case phrases count 1, identifiers 2."""
    found = F.concat(
        F.transform(F.regexp_extract_all("content", F.lit(TITLE_ENTITY), F.lit(0)), lambda e: F.struct(e.alias("raw"), F.lit(1).alias("score"))),
        F.transform(F.regexp_extract_all("content", F.lit(IDENTIFIER), F.lit(0)), lambda e: F.struct(e.alias("raw"), F.lit(2).alias("score"))),
    )
    rows = belonging.select("doc_id", "section_id", F.explode(found).alias("e"))
    entity = F.regexp_replace(F.trim(F.col("e.raw")), r"\s+", " ")
    rows = rows.select("doc_id", "section_id", entity.alias("entity"), "e.score").where(~F.lower("entity").isin(*rules.stopwords))
    scored = dealt(rows, tasks, "doc_id", "section_id").groupBy("doc_id", "section_id", "entity").agg(F.sum("score").alias("score"))
    order = Window.partitionBy("doc_id", "section_id").orderBy(F.desc("score"), F.lower("entity"), "entity")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.entities)


def data_type(chunk_type: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in DATA_TYPES.items() for x in kv]), chunk_type)


def data_types(belonging: DataFrame) -> DataFrame:
    """The sorted data types of every section."""
    return belonging.groupBy("doc_id", "section_id").agg(F.array_sort(F.collect_set(data_type(F.col("chunk_type")))).alias("data_types"))


def summaries(belonging: DataFrame, rules: IndexRules = IndexRules()) -> DataFrame:
    """An extractive summary per section: the first sentences of its first chunks, three at most.

    A model-backed summariser takes the same requests: the first chunks of a section.
    """
    order = Window.partitionBy("doc_id", "section_id").orderBy("sort_path", "n")
    first = belonging.where("chunk_type <> 'section_header'").withColumn("k", F.row_number().over(order)).where(F.col("k") <= rules.summary_chunks)
    request = first.groupBy("doc_id", "section_id").agg(F.array_sort(F.collect_list(F.struct("k", "chunk_id", "content"))).alias("c"))
    text = F.array_join(F.transform("c", lambda c: c["content"]), " ")
    sentences = F.filter(F.split(F.regexp_replace(text, r"\n", ". "), r"[.?]"), lambda s: F.length(F.trim(s)) > 0)
    return request.select("doc_id", "section_id", F.array_join(F.transform(F.slice(sentences, 1, 3), lambda s: F.trim(s)), ". ").alias("summary"), F.size("c").alias("n_sources"))


#: Steps of the power iteration, and sentences of a central summary.
STEPS, SENTENCES = 3, 3
#: Sections that are weighed at a time.
WEIGHED = 1024


def _distinct(major: np.ndarray, minor: pa.Array) -> np.ndarray:
    """Where each pair of a number and a text is met first, in order."""
    code = minor.dictionary_encode()
    key = major * max(1, len(code.dictionary)) + code.indices.to_numpy()
    return np.sort(np.unique(key, return_index=True)[1])


def _central(sections: pa.RecordBatch) -> pa.RecordBatch:
    """The central sentences of some sections (doc_id, section_id, chunks with content, lower content and chunk_id)."""
    lists = sections.column("chunks")
    of, chunks = pc.list_parent_indices(lists).to_numpy(), pa.StructArray.flatten(pc.list_flatten(lists))
    said, low, chunk_id = (chunks[lists.type.value_type.get_field_index(c)] for c in ("content", "low", "chunk_id"))
    cut = lambda text: pc.split_pattern_regex(pc.replace_substring(text, "\n", ". "), "[.?]")
    said = cut(said)
    at, sentence, low = pc.list_parent_indices(said).to_numpy(), pc.utf8_trim(pc.list_flatten(said), " "), pc.list_flatten(cut(low))
    some = np.flatnonzero(pc.binary_length(sentence).to_numpy(zero_copy_only=False) > 0)
    some = some[_distinct(of[at[some]], sentence.take(pa.array(some)))]
    sentence, low, at = sentence.take(pa.array(some)), low.take(pa.array(some)), at[some]
    section = of[at]
    words = pc.split_pattern_regex(low, "[^a-z0-9]+")
    owner, term = pc.list_parent_indices(words).to_numpy(), pc.list_flatten(words)
    full = np.flatnonzero(pc.binary_length(term).to_numpy(zero_copy_only=False) > 0)
    full = full[_distinct(owner[full], term.take(pa.array(full)))]
    owner, code = owner[full], term.take(pa.array(full)).dictionary_encode()
    joint = np.unique(section[owner] * max(1, len(code.dictionary)) + code.indices.to_numpy(), return_inverse=True)[1]
    weights = np.ones(len(section), "i8")
    for step in range(STEPS):
        # What a term's other sentences weigh, summed up over the terms of each.
        total, new = np.zeros(joint.max(initial=-1) + 1, weights.dtype), np.zeros_like(weights)
        np.add.at(total, joint, weights[owner])
        np.add.at(new, owner, total[joint] - weights[owner])
        weights = new
        if step == 0 and (int(weights.max(initial=0)) + 1) ** STEPS >= 2**63:
            weights = weights.astype(object)
    order = np.argsort(-weights, kind="stable")
    order = order[np.argsort(section[order], kind="stable")]
    best = np.sort(order[np.arange(len(order)) - np.searchsorted(section, section[order]) < SENTENCES])
    found, counts = np.unique(section[best], return_counts=True)
    lists = lambda values: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype("i4")), values)
    summary = pc.binary_join(lists(sentence.take(pa.array(best))), ". ")
    ids = [sections.column(c).take(pa.array(found)) for c in ("doc_id", "section_id")]
    return pa.RecordBatch.from_arrays([*ids, summary, lists(chunk_id.take(pa.array(at[best])))], ["doc_id", "section_id", "summary", "sources"])


def _central_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, len(batch), WEIGHED):
            yield _central(batch.slice(i, WEIGHED))


def central_summaries(belonging: DataFrame, rules: IndexRules = IndexRules()) -> DataFrame:
    """(doc_id, section_id, summary, sources): the most central sentences of a section's first chunks, in text order.

    Sentences are joined by how many terms they share; from one each, weights go along these
    joints ``STEPS`` times, as whole numbers. Sentences that say the same count once, the first of
    them. ``sources`` are the chunks that the chosen sentences stand in. A section's request is
    bounded by ``summary_chunks``, so its graph stays in its row. A weight goes to the terms of its
    sentence and from there to the sentences that have them, less itself, so the work is in
    proportion to the terms and no pair of sentences is met.
    """
    order = Window.partitionBy("doc_id", "section_id").orderBy("sort_path", "n")
    first = belonging.where("chunk_type <> 'section_header'").withColumn("k", F.row_number().over(order)).where(F.col("k") <= rules.summary_chunks)
    request = first.groupBy("doc_id", "section_id").agg(F.array_sort(F.collect_list(F.struct("k", "chunk_id", "content"))).alias("c"))
    # Lower case is Spark's; it moves no end of a sentence.
    text = lambda c: F.coalesce(c["content"], F.lit(""))
    request = request.select("doc_id", "section_id", F.transform("c", lambda c: F.struct(c["chunk_id"].alias("chunk_id"), text(c).alias("content"), F.lower(text(c)).alias("low"))).alias("chunks"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in request.drop("chunks").schema)
    return request.mapInArrow(_central_batches, f"{kinds}, summary string, sources array<string>").withColumn("sources", F.array_distinct("sources"))


def sentence_count_fits(text: Column) -> Column:
    """Whether a text has two or three sentences; exclamation marks end none."""
    return F.size(F.filter(F.split(text, r"[.?]"), lambda s: F.length(F.trim(s)) > 0)).between(2, 3)
