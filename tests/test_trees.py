"""Pages of blocks against plain walks over the same trees."""

import random
import re

from gristmill.operators import trees
from pyspark.sql import functions as F

SCHEMA = "page string, id string, parent string, pos long, type string, text string"
KINDS = ["paragraph"] * 5 + ["image", "heading_1", "heading_2", "toggle", "toggle"]
TEXTS = ["", None, "a", " 7 ", "12", "123", "b\nc", trees.SOURCE + " (5)", "x " + trees.DRAFT, trees.DRAFT, "long " * 30]


def made(seed, pages=12):
    rng, rows = random.Random(seed), []
    for p in range(pages):
        ids = []
        for i in range(rng.randrange(0, 40) if p else 300):
            parent = rng.choice(ids) if ids and rng.random() < 0.4 else None
            rows.append((f"p{p}", f"{p}-{i}", parent, i, rng.choice(KINDS), rng.choice(TEXTS)))
            ids.append(f"{p}-{i}")
    return rows + [("p0", "lost", "nobody", 1, "paragraph", "lost"), ("p1", "round", "round2", 1, "paragraph", "r"), ("p1", "round2", "round", 1, "paragraph", "r")]


def children(rows, page, parent):
    return sorted((r for r in rows if r[0] == page and r[2] == parent), key=lambda r: r[3])


def walk(rows, page):
    body, lines, cleared, started, image, slot = [], [], [], False, False, 0
    for _, i, _, _, kind, text in children(rows, page, None):
        text = text or ""
        if kind.startswith("heading") and trees.DRAFT in text:
            started = True
        if not started:
            if kind == "toggle" and text.startswith(trees.SOURCE):
                body += [c[5] for c in children(rows, page, i) if c[5]]
            elif text:
                body.append(text)
        elif not kind.startswith("heading"):
            if kind == "image":
                image, slot = True, slot + 1
                cleared.append((page, i, slot))
            elif kind == "paragraph":
                lines.append(text)
                slot += bool(re.match(r"^\d{1,2}$", text.strip()))
    return "\n".join(body), ("\n\n".join(lines), image), cleared


def test_walks(spark):
    rows = made(4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    pages = {r[0] for r in rows}
    want = {p: walk(rows, p) for p in pages}
    assert {r.page: r.body for r in trees.source_bodies(df).collect()} == {p: w[0] for p, w in want.items()}
    assert {r.page: (r.draft, r.has_image) for r in trees.drafts_of(df).collect()} == {p: w[1] for p, w in want.items()}
    cleared = {tuple(r) for r in trees.cleared_images(df).collect()}
    assert cleared == {c for w in want.values() for c in w[2]} and cleared
    after = {r.id: r for r in trees.without_images(df).collect()}
    assert len(after) == len({r[1] for r in rows})
    assert all(after[i].type == "paragraph" and after[i].text == str(slot) for _, i, slot in cleared)


def test_order_is_depth_first(spark):
    rows = made(9, 4)
    got = [(r.page, r.id) for r in trees.with_paths(spark.createDataFrame(rows, SCHEMA)).orderBy("page", "path").collect()]

    def below(page, parent):
        for r in children(rows, page, parent):
            yield page, r[1]
            yield from below(page, r[1])

    assert got == [x for p in sorted({r[0] for r in rows}) for x in below(p, None)]


def test_drafts_appended(spark, monkeypatch):
    monkeypatch.setattr(trees, "BLOCK_CHARS", 7)
    rng = random.Random(2)
    drafts = [(f"p{k}", "\n".join(rng.choice(["", "  ", "ab  ", " 3 ", "12", "cdefghijk", "123", "/* x */"]) for _ in range(rng.randrange(1, 30)))) for k in range(20)] + [("e", ""), ("n", None)]
    images = [(f"p{k}", s, f"image {k} {s}") for k in range(0, 20, 2) for s in (0, 2)]
    got = {}
    for r in trees.batches(trees.drafted_blocks(spark.createDataFrame(drafts, "page string, draft string"), spark.createDataFrame(images, "page string, slot int, image string")), size=4).collect():
        assert r.batch == (r.rn - 1) // 4
        got.setdefault(r.page, []).append((r.rn, r.type, r.text))
    for page, draft in drafts:
        want, buffer, slot = [("divider", ""), ("heading_1", trees.DRAFT)], [], -1
        have = {s: i for p, s, i in images if p == page}

        def flush():
            text = "\n".join(buffer)
            want.extend(("paragraph", text[i : i + 7]) for i in range(0, len(text), 7))
            buffer.clear()

        for raw in (draft or "").split("\n"):
            line, bare = raw.rstrip(), raw.strip()
            if not bare:
                flush()
            elif re.match(r"^\d{1,2}$", bare):
                flush()
                slot += 1
                want.append(("image", have[slot]) if slot in have else ("paragraph", bare))
            else:
                buffer.append(line)
        flush()
        assert [x[1:] for x in sorted(got[page])] == want


def test_lines_as_blocks(spark):
    text = "# one\n## two\n\n  three \n#four\n" + "z" * 4500
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(trees.markdown_blocks(F.col("t")).alias("m"), trees.plain_blocks(F.col("t")).alias("p")).first()
    tail = [("paragraph", "z" * 2000), ("paragraph", "z" * 2000), ("paragraph", "z" * 500)]
    assert [tuple(x) for x in row.m] == [("heading_1", "one"), ("heading_2", "two"), ("paragraph", "three"), ("paragraph", "#four"), *tail]
    assert [tuple(x) for x in row.p] == [("paragraph", "# one"), ("paragraph", "## two"), ("paragraph", "three"), ("paragraph", "#four"), *tail]
    rich = spark.createDataFrame([([("a",), (None,), ("b",)],), (None,), ([],)], "r array<struct<plain_text:string>>")
    assert [r[0] for r in rich.select(trees.plain_text(F.col("r"))).collect()] == ["ab", "", ""]


def test_no_blocks(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trees.source_bodies(none).count() == trees.drafts_of(none).count() == trees.cleared_images(none).count() == 0
