"""Glyphs drawn in the task that reads their lines, against loose glyph rows and plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.operators import layout as lay
from docweave.plans import layout_queries as q

LONG = "\n".join(f"Ein längerer Satz Nummer {n} é  ENDE" for n in range(45))
ROWS = [
    (1, "de", LONG), (2, "fr", "Été\n\nzwei  AA Blöcke\r\tX"), (2, "fr", "Été\n\nzwei  AA Blöcke\r\tX"), (None, "es", "OHNE id\nzwei"),
    (4, None, "no language\nTwo"), (5, "en", None), (6, "en", ""), (7, "en", " \n "), (8, "es", "😀 日本 Ü\n" + "x A" * 3000),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("glyphs"))
    spark.createDataFrame(ROWS, "doc_id long, lang string, text string").write.parquet(f"{path}/documents.parquet")
    return path


def rows_of(df):
    return sorted(map(repr, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]


@pytest.fixture(scope="module")
def loose(spark, folder):
    """Glyph rows in no order, which the operators gather themselves."""
    pages = q.page_rows(spark, folder)
    return lay.scan_pages(pages, source=q.drawn(pages)).orderBy(F.rand(3))


def counts(df, *keys):
    return df.groupBy("doc_id", "page", *keys).agg(F.count(F.lit(1)).alias("n"))


def travels_as_text(df):
    """One exchange, of lines: no glyph is shuffled, sorted or counted outside the pass over the pages."""
    plan = plan_of(df)
    return plan.count("Exchange hash") == 1 and "Aggregate" not in plan and "space_w" not in plan


def test_glyph_diacritics_f1(spark, folder, loose):
    got = q.glyph_diacritics(spark, folder)
    assert rows_of(got) == rows_of(counts(lay.merge_marks(lay.drop_overprints(lay.arrange(loose))), "ch"))
    assert travels_as_text(got)


def test_glyph_lines_f2(spark, folder, loose):
    got = q.glyph_lines(spark, folder)
    placed = lay.place_glyphs(lay.merge_marks(lay.drop_overprints(lay.arrange(loose))))
    assert rows_of(got) == rows_of(counts(placed, F.col("line_no").cast("long").alias("line_no")))
    assert travels_as_text(got)


def test_glyph_dedup_f7(spark, folder, loose):
    got = q.glyph_dedup(spark, folder)
    assert rows_of(got) == rows_of(counts(lay.drop_overprints(lay.arrange(loose))))
    assert travels_as_text(got)


def test_glyph_words_f9(spark, folder, loose):
    got = q.glyph_words(spark, folder)
    lines = lay.page_lines(lay.arrange(loose))
    assert rows_of(got) == rows_of(counts(lines, F.array_join("words", " ").alias("line")))
    assert travels_as_text(got)


def test_overprints_as_a_loop(spark):
    random = np.random.default_rng(5)
    rows = [
        (int(p), 0, n, "ab"[c], float(x) / 4, float(y) / 4, 3.0 * (1 + n % 2), 10.0, 3.0, "f", 10.0)
        for n, (p, c, x, y) in enumerate(zip(*(random.integers(0, k, 1500) for k in (5, 2, 120, 60))))
    ]
    schema = "doc_id long, page int, seq long, ch string, x double, y double, w double, h double, space_w double, font string, font_size double"
    got = {r.seq for r in lay.drop_overprints(lay.arrange(spark.createDataFrame(rows, schema))).collect()}
    kept = []
    for r in rows:
        n = r[6] / 3
        if not any(r[0] == k[0] and r[3] == k[3] and r[4] - n <= k[4] < r[4] + n and r[5] - n <= k[5] < r[5] + n for k in kept):
            kept.append(r)
    assert got == {k[2] for k in kept} and len(kept) < len(rows)


def test_glyph_bead_assign_f10(spark, folder, loose):
    got = q.glyph_bead_assign(spark, folder)
    box = lambda *v: F.struct(*[F.lit(float(x)).alias(k) for k, x in zip(("left", "bottom", "right", "top"), v)])
    placed = lay.assign_sections(loose.withColumn("beads", F.array(box(60, 24, 300, 100), box(300, 0, 900, 500))))
    assert rows_of(got) == rows_of(counts(placed, "section")) and travels_as_text(got)


def test_sections_of_odd_rectangles(spark):
    one, two, part = (0.0, 0.0, 5.0, 5.0), (4.0, 4.0, 9.0, 9.0), (None, 1.0, 8.0, 3.0)
    beads = [None, [], [one], [one, two], [two, one], [None, two], [part, one], [two, None]]
    places = [(1.0, 1.0), (5.0, 5.0), (6.0, 7.0), (9.5, 9.5), (None, 2.0), (2.0, None), (-1.0, 20.0)]
    rows = [(n, k, x, y, b) for n, b in enumerate(beads) for k, (x, y) in enumerate(places)]
    schema = "doc_id long, page int, x double, y double, beads array<struct<left: double, bottom: double, right: double, top: double>>"
    df = spark.createDataFrame(rows, schema).repartition(3, "doc_id").sortWithinPartitions("doc_id", "page")
    assert rows_of(lay.scan_pages(df, lay.section_stage)) == rows_of(lay.assign_sections(df))


def test_sort_glyphs_f3(spark, folder, loose):
    got = q.sort_glyphs(spark, folder)
    merged = lay.merge_marks(lay.drop_overprints(lay.arrange(loose.withColumn("seq", -F.col("seq")))))
    ranked = lay.scan_pages(lay.reorder(lay.gather_pages(merged), by_position=True), lay.rank_stage)
    lines = {}
    for r in ranked.orderBy("doc_id", "page", "rank").collect():
        lines.setdefault((r.doc_id, r.page), {}).setdefault(r.y, []).append(r.ch)
    want = {k: "|".join("".join(v) for v in page.values()) for k, page in lines.items()}
    assert {(r.doc_id, r.page): r.content for r in got.collect()} == want and travels_as_text(got)
    odd = merged.withColumn("x", F.when(F.col("seq") % 7 == 0, None).when(F.col("seq") % 5 == 0, float("nan")).otherwise(F.col("x")))
    ranked = lay.scan_pages(lay.reorder(lay.gather_pages(odd), by_position=True), lay.rank_stage)
    assert rows_of(lay.sort_glyphs(odd)) == rows_of(ranked)
