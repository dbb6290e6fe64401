"""Line dedup of lines of any length against brute force, and as the query and the pipeline call it."""

from __future__ import annotations

import corpus_pipeline
from haulmart.llm import line_dedup, queries
from tests.llm.test_text_operators import deduplicated, line_rows


def short_rows():
    rows = line_rows()
    rows += [(60 + k, "今日は天気がいい。\nok\n \n\n" + "x" * 19 + "\nab\nok") for k in range(4)]
    return rows + [(70, "x" * 19 + "\n今日は天気がよい。\n" + "x" * 20 + "\n" + "y" * 19), (71, "ab\n\t\nab"), (72, "y" * 19)]


def test_short_lines_lose_equal_ones(docs_of):
    rows = short_rows()
    clean = line_dedup.without_repeats(docs_of(rows).repartition(4))
    assert sorted((str(r.doc_id), r.text) for r in clean.collect()) == deduplicated(rows)


def test_query_and_stage_take_short_lines(spark, docs_of, tmp_path):
    rows = [(i, t) for i, t in short_rows() if i is not None]
    frame = docs_of(rows)
    expected = dict(deduplicated(rows))
    stage = corpus_pipeline.line_repeats(spark, frame, "")
    assert {str(r.doc_id): r.text for r in stage.collect()} == expected
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    left = {str(r.doc_id): r.n_left for r in queries.op8_line_dedup(spark, str(tmp_path)).collect()}
    assert left == {i: len(t.split("\n")) if t else 0 for i, t in expected.items()}
