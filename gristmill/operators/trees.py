"""Pages as trees of blocks: ordered flattening, sections by running headings, drafts appended and pictures taken out again.

A table of blocks has (page, id, parent, pos, type, text): parent is null at the top of a page, pos orders the children of one parent.
All order comes from a path, the places from the top down, so a page of any length is dealt over tasks and read in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import chunks, strip
from gristmill.operators.greedy import cut
from gristmill.operators.ordering import running

#: The heading that a draft stands below, the beginning of the toggle that holds the source, a slot line.
DRAFT, SOURCE, SLOT = "블로그 초안", "📄 원문 기사", r"^\d{1,2}$"
#: Fixed value: the characters of a block, and the blocks of a request, at most.
BLOCK_CHARS, REQUEST = 2000, 100


def plain_text(parts: Column) -> Column:
    """The text of a list of rich-text parts (plain_text, ...); empty if there is none."""
    return F.coalesce(F.array_join(F.transform(parts, lambda p: F.coalesce(p["plain_text"], F.lit(""))), ""), F.lit(""))


def _step(pos: Column) -> Column:
    """A place as text that sorts like the number."""
    return F.lpad(pos.cast("string"), 19, "0")


def with_paths(blocks: DataFrame) -> DataFrame:
    """blocks with path and depth (0 at the top), one round of a join a level. Blocks that no top leads to are left out.

    A block whose parent is one of its own children is part of no page, so no round ever reaches it.
    """
    children = cut(blocks.where("parent is not null"))
    level = cut(blocks.where("parent is null").withColumn("path", _step(F.col("pos"))).withColumn("depth", F.lit(0)))
    done = level
    while True:
        above = level.select(F.col("page").alias("_page"), F.col("id").alias("_id"), F.col("path").alias("_path"), F.col("depth").alias("_depth"))
        level = children.join(above, F.col("page").eqNullSafe(F.col("_page")) & (F.col("parent") == F.col("_id")))
        level = level.withColumn("path", F.concat("_path", F.lit("/"), _step(F.col("pos")))).withColumn("depth", F.col("_depth") + 1)
        level = cut(level.select(done.columns))
        if level.isEmpty():
            return done
        done = cut(done.unionByName(level))


def after_heading(placed: DataFrame, marker: str) -> DataFrame:
    """placed, blocks with paths, with `sections`: how many top headings that hold marker stand at or before each block of its page."""
    is_heading = (F.col("depth") == 0) & F.startswith("type", F.lit("heading")) & F.contains(F.coalesce("text", F.lit("")), F.lit(marker))
    return running(placed, ["page"], ["path"], is_heading.cast("long"), "sections")


def source_bodies(blocks: DataFrame, marker: str = DRAFT, toggle: str = SOURCE) -> DataFrame:
    """(page, body) of every page: the texts above the draft's heading, with the children of source toggles in their place.

    A toggle's own text isn't part of the body, and of what is below other blocks nothing is. Empty texts are left out. A page
    without any text has an empty body.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = after_heading(with_paths(blocks), marker)
    opens = (F.col("type") == "toggle") & F.startswith(text, F.lit(toggle))
    opened = placed.where((F.col("depth") == 0) & opens).select(F.col("page").alias("_page"), F.col("id").alias("parent"), F.lit(True).alias("_opened"))
    inside = placed.where("depth = 1").join(opened, F.col("page").eqNullSafe(F.col("_page")) & (placed["parent"] == opened["parent"])).select(placed["page"], "path", "sections", "text")
    lines = placed.where((F.col("depth") == 0) & ~opens).select("page", "path", "sections", "text").unionByName(inside)
    lines = lines.where((F.col("sections") == 0) & (text != "")).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("path", "text"))).alias("l"))
    lines = lines.select("page", F.array_join(F.transform("l", lambda x: x["text"]), "\n").alias("body"))
    pages = blocks.select(F.col("page").alias("_page")).distinct()
    return pages.join(lines, F.col("_page").eqNullSafe(F.col("page")), "left").select(F.col("_page").alias("page"), F.coalesce("body", F.lit("")).alias("body"))


def drafts_of(blocks: DataFrame, marker: str = DRAFT) -> DataFrame:
    """(page, draft, has_image) of every page: the paragraphs below the draft's heading, a blank line between them, and whether
    there is a picture. Headings below it aren't part of the draft."""
    top = after_heading(with_paths(blocks), marker).where("depth = 0 and sections > 0")
    found = top.groupBy("page").agg(
        F.array_sort(F.collect_list(F.when(F.col("type") == "paragraph", F.struct("path", F.coalesce("text", F.lit("")).alias("text"))))).alias("l"),
        F.coalesce(F.bool_or(F.col("type") == "image"), F.lit(False)).alias("has_image"),
    )
    pages = blocks.select(F.col("page").alias("_page")).distinct()
    joined = pages.join(found, F.col("_page").eqNullSafe(F.col("page")), "left")
    draft = F.array_join(F.transform("l", lambda x: x["text"]), "\n\n")
    return joined.select(F.col("_page").alias("page"), F.coalesce(draft, F.lit("")).alias("draft"), F.coalesce("has_image", F.lit(False)).alias("has_image"))


def cleared_images(blocks: DataFrame, marker: str = DRAFT) -> DataFrame:
    """(page, id, slot) of the pictures to delete below the draft's heading, and the slot number to put in the place of each.

    Slots are counted in order over pictures and over number lines that are still open.
    """
    open_slot = (F.col("type") == "paragraph") & strip(F.coalesce(F.col("text"), F.lit(""))).rlike(SLOT)
    top = after_heading(with_paths(blocks), marker).where("depth = 0 and sections > 0").withColumn("_slot", open_slot | (F.col("type") == "image"))
    return running(top, ["page"], ["path"], F.col("_slot").cast("long"), "slot").where("type = 'image'").select("page", "id", "slot")


def without_images(blocks: DataFrame, marker: str = DRAFT) -> DataFrame:
    """blocks after cleared_images: a paragraph with its slot number stands in the place of each picture, under the picture's id."""
    gone = cleared_images(blocks, marker).select(F.col("page").alias("_page"), F.col("id").alias("_id"), F.col("slot"))
    joined = blocks.join(gone, F.col("page").eqNullSafe(F.col("_page")) & (F.col("id") == F.col("_id")), "left")
    was = F.col("slot").isNotNull()
    return joined.withColumn("type", F.when(was, "paragraph").otherwise(F.col("type"))).withColumn("text", F.when(was, F.col("slot").cast("string")).otherwise(F.col("text"))).select(blocks.columns)


def _paragraphs(runs: Column, kind: str) -> Column:
    """Runs of text as blocks (type, text) of at most BLOCK_CHARS."""
    return F.flatten(F.transform(runs, lambda t: F.transform(chunks(t, BLOCK_CHARS), lambda c: F.struct(F.lit(kind).alias("type"), c.alias("text")))))


def plain_blocks(text: Column) -> Column:
    """Each line that isn't blank as paragraphs (type, text)."""
    return _paragraphs(F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != ""), "paragraph")


def markdown_blocks(text: Column) -> Column:
    """Each line that isn't blank as blocks (type, text): headings of one and two marks, else paragraphs."""

    def block(line: Column) -> Column:
        kind = F.when(F.startswith(line, F.lit("## ")), "heading_2").when(F.startswith(line, F.lit("# ")), "heading_1").otherwise("paragraph")
        own = F.when(kind == "heading_2", F.substring(line, 4, 2**31 - 1)).when(kind == "heading_1", F.substring(line, 3, 2**31 - 1)).otherwise(line)
        return F.transform(chunks(own, BLOCK_CHARS), lambda c: F.struct(kind.alias("type"), c.alias("text")))

    return F.flatten(F.transform(F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != ""), block))


def drafted_blocks(drafts: DataFrame, images: DataFrame, marker: str = DRAFT) -> DataFrame:
    """(page, rn, type, text) of what a draft (page, draft) adds to its page, in order from 1: a divider, the heading, and the draft.

    Lines between blank lines are one paragraph; a slot line is a paragraph of its own, or the picture (page, slot, image), slots
    counted from 0, if there is one. Paragraphs are cut at BLOCK_CHARS. Lines lose the blanks at their ends only.
    """
    # a line is blank, a slot, or text; runs of text lines between the other two are one paragraph
    lines = drafts.select("page", F.posexplode(F.split(F.coalesce("draft", F.lit("")), "\n")).alias("at", "raw"))
    lines = lines.withColumn("line", F.regexp_replace("raw", r"(?U)\s+$", "")).withColumn("bare", strip(F.col("raw")))
    kind = F.when(F.col("bare") == "", "blank").when(F.col("bare").rlike(SLOT), "slot").otherwise("text")
    lines = running(lines.select("page", "at", "line", "bare", kind.alias("kind")), ["page"], ["at"], (F.col("kind") != "text").cast("long"), "run")
    slots = running(lines.where("kind = 'slot'"), ["page"], ["at"], F.lit(1), "slot").withColumn("slot", F.col("slot") - 1)
    found = images.select(F.col("page").alias("_page"), F.col("slot").cast("long").alias("_slot"), "image")
    slots = slots.join(found, F.col("page").eqNullSafe(F.col("_page")) & (F.col("slot") == F.col("_slot")), "left")
    pictures = slots.select("page", "at", F.when(F.col("image").isNotNull(), "image").otherwise("paragraph").alias("type"), F.coalesce("image", "bare").alias("text"), F.lit(0).alias("piece"))
    texts = lines.where("kind = 'text'").groupBy("page", "run").agg(F.min("at").alias("at"), F.array_sort(F.collect_list(F.struct("at", "line"))).alias("l"))
    texts = texts.select("page", "at", F.posexplode(chunks(F.array_join(F.transform("l", lambda x: x["line"]), "\n"), BLOCK_CHARS)).alias("piece", "text"))
    head = drafts.select("page", F.inline(F.array(*(F.struct(F.lit(at).alias("at"), F.lit(kind).alias("type"), F.lit(text).alias("text")) for at, kind, text in ((-2, "divider", ""), (-1, "heading_1", marker))))))
    order = ["page", "at", "piece", "type", "text"]
    parts = head.withColumn("piece", F.lit(0)).select(order).union(pictures.select(order)).union(texts.withColumn("type", F.lit("paragraph")).select(order))
    return running(parts, ["page"], ["at", "piece"], F.lit(1), "rn").select("page", "rn", "type", "text")


def batches(rows: DataFrame, rn: str = "rn", size: int = REQUEST) -> DataFrame:
    """rows with batch, from 0: what one request sends."""
    return rows.withColumn("batch", F.floor((F.col(rn) - 1) / size))
