"""Long runs of the n-gram join are dealt to blocks of bounded size."""

from __future__ import annotations

from haulmart.llm import ngram_join
from tests.llm.test_bands import family
from tests.llm.test_pairs import components_of, found


def test_long_runs_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF_RUN", 1)
    monkeypatch.setattr(ngram_join, "RUN_BLOCK", 5)
    monkeypatch.setattr(ngram_join, "ASKED_AT_ONCE", 3)
    most = []
    candidates = ngram_join.Join.candidates

    def watched(self, crossing, points, nearest):
        own = self.blocks(crossing, points, nearest).where("own").groupBy("token", "level", "block").count()
        runs = own.groupBy("token", "level").agg({"count": "sum"})
        most.append((own.agg({"count": "max"}).first()[0] or 0, runs.agg({"sum(count)": "max"}).first()[0] or 0))
        return candidates(self, crossing, points, nearest)

    monkeypatch.setattr(ngram_join.Join, "candidates", watched)
    rows = family(30)
    assert found(ngram_join.similar_documents(docs_of(rows).repartition(3))) == components_of(rows)
    # The longest run has many times the points of the largest block.
    assert max(run for _, run in most) >= 40 and all(3 * block <= run for block, run in most if run >= 40)
