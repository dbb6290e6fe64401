"""Quality rules, line dedup, licenses, URLs and fixity against brute force."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from haulmart.llm import fixity, licenses, line_dedup, quality, url_rules
from haulmart.llm.queries import URL_RULES
from tests.llm.conftest import WORD, odd_documents, prose


def counts_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + d for k, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)} if len(words) < 3000 else None
    if covered is None:
        seen = {}
        for k, w in enumerate(windows):
            seen.setdefault(w, []).append(k)
        covered = {k + d for places in seen.values() if len(places) > 1 for k in places for d in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered),
    )


def test_quality_counts(docs_of):
    rows = odd_documents() + [(20, "a b c\na b c\na b c d"), (21, "|a|b|\n\n \n|a|b|"), (22, "z z z z z")]
    found = quality.judged(docs_of(rows)).collect()
    own = sorted((str(r.doc_id), *[r[c] for c in quality.COUNTS], r.base_failed) for r in found)
    expected = []
    for doc_id, text in rows:
        c = counts_of(text)
        expected.append((str(doc_id), *c, c[0] < 50 or 100 * c[5] > 50 * c[0]))
    assert own == sorted(expected)
    assert all(not (r.base_failed and r.kept) for r in found)


def corpus():
    rows = [(i, prose(i, 120), "en", "hot" if i % 3 else None) for i in range(150)]
    rows += [(1000 + i, " ".join(w + "##" for w in prose(500 + i, 120).split()), "en", "hot") for i in range(5)]
    rows += [(2000, prose(7, 120), "fr", "rare"), (2001, None, None, None)]
    return rows


def test_thresholds_follow_the_group(docs_of):
    kept = {r.doc_id: r.kept for r in quality.judged(docs_of(corpus())).collect()}
    assert all(kept[i] for i in range(150)) and kept[2000]
    assert not any(kept[1000 + i] for i in range(5)) and not kept[2001]


def test_kept_documents_are_the_judged_ones(docs_of):
    frame = docs_of(corpus())
    left = quality.kept_documents(frame)
    assert left.columns == frame.columns
    kept = {r.doc_id for r in quality.judged(frame).collect() if r.kept}
    assert {r.doc_id for r in left.collect()} == kept


def test_clashing_columns_pass_the_filter(docs_of):
    names = ("_lang", "_source", "most_symbols", "_quality_text", "_quality_n_words", "c0", "a.b", "n_words")
    frame = docs_of(corpus()).select("*", *[F.lit(name).alias(name) for name in names])
    left = quality.kept_documents(frame)
    assert left.columns == frame.columns
    assert all(r[name] == name for r in left.collect() for name in names)
    assert sorted(r.doc_id for r in left.collect()) == sorted(r.doc_id for r in quality.kept_documents(docs_of(corpus())).collect())


def test_quantiles_do_not_depend_on_the_partitions(docs_of):
    frame = docs_of(corpus())
    few, many = (sorted(map(str, quality.judged(frame.repartition(n)).collect())) for n in (1, 7))
    assert few == many


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def deduplicated(rows):
    """Lines with a word lose equal ones, those of 20 code points or more also near ones."""
    lines = {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for k, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                lines.setdefault(line, (str(doc_id), k))
    known = [x for x in lines if len(x) >= 20]
    near = {
        b
        for n, b in enumerate(known)
        if any(abs(len(a) - len(b)) <= 2 and distance(a, b) <= (1 if min(len(a), len(b)) < 40 else 2) for a in known[:n])
    }
    stay = {place for line, place in lines.items() if line not in near}
    return sorted(
        (str(i), "\n".join(x for k, x in enumerate((t or "").split("\n")) if not WORD.search(x) or (str(i), k) in stay))
        for i, t in rows
    )


def line_rows():
    rng = __import__("random").Random(2)
    base = [prose(i, n) for i, n in enumerate((4, 5, 6, 9, 12, 20, 40, 80) * 3)]
    rows = []
    for doc_id in range(1, 40):
        lines = []
        for line in rng.sample(base, 6):
            chars = list(line)
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(chars))
                chars[k : k + 1] = rng.choice([[], ["x"], [chars[k], "y"]])
            lines.append("".join(chars))
        rows.append((doc_id, "\n".join(lines + ["short", ""])))
    return rows + [(50, None), (51, ""), (52, "\n\n"), (None, base[0] + "\n" + base[3])]


def test_line_dedup(docs_of):
    """Extra columns keep their values, also those named like working columns."""
    rows = line_rows()
    names = ("_row", "_kept", "_lines", "__id", "a.b")
    frame = docs_of(rows).select("*", *[F.lit(name).alias(name) for name in names])
    clean = line_dedup.without_repeats(frame.repartition(4))
    assert clean.columns == frame.columns
    found = clean.collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == deduplicated(rows)
    assert all(r[name] == name for r in found for name in names) and {r._id for r in found} == {"x"}


@pytest.mark.parametrize("length", [20, 30, 39, 40, 51])
def test_every_pair_of_near_lines_is_found(docs_of, length):
    """Edits at every place, at the lengths where classes and thresholds change."""
    rng = __import__("random").Random(length)
    line = "".join(rng.choice("abcdefgh ") for _ in range(length - 1)) + "z"
    rows = []
    for k in range(60):
        # A letter of each document's own makes lines of different documents differ, but for the two of a pair.
        own = "".join(rng.choice("ijklmnopqrstuv") if rng.random() < 0.5 else c for c in line)
        changed = list(own)
        for _ in range(1 if length < 40 else 2):
            at = rng.randrange(len(changed) + 1)
            kind = rng.choice(["in", "out", "change"])
            changed[at : at + (kind != "in")] = [] if kind == "out" else [rng.choice("äöü")]
        rows += [(2 * k, own), (2 * k + 1, "".join(changed))]
    found = {(str(r.doc_id), r.text) for r in line_dedup.without_repeats(docs_of(rows)).collect()}
    assert found == set(deduplicated(rows))


def test_bit_parallel_distance(spark):
    rng = __import__("random").Random(4)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))
        b = "".join(c for c in a + rng.choice(["", "a", "bc"]) if rng.random() > 0.15)
        pairs.append((a, b))
    frame = spark.createDataFrame(pairs, "a string, b string")
    chars = frame.select(*[F.filter(F.split(c, ""), lambda x: x != "").alias(c) for c in "ab"], F.levenshtein("a", "b").alias("d"))
    for k in (1, 2, 3):
        wrong = chars.where(F.expr(line_dedup.within(k, "a", "b")) != (F.col("d") <= k))
        assert wrong.count() == 0


def test_no_rows(docs_of, spark):
    empty = docs_of([])
    assert quality.judged(empty).count() == 0
    assert quality.kept_documents(empty).count() == 0
    assert line_dedup.without_repeats(empty).count() == 0
    templates = spark.createDataFrame(licenses.TEMPLATES, "template string, text string")
    assert licenses.scan_licenses(empty, templates).count() == 0
    assert licenses.scan_licenses(docs_of(odd_documents()), templates.limit(0)).count() == 0


def license_rows(spark, rows, templates):
    def shingles(text):
        w = re.sub(r"[^a-z0-9]+", " ", (text or "").lower()).split()
        return [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []

    expected = set()
    for doc_id, text in set(rows):
        own = shingles(text)
        for name, template in templates:
            wanted = set(shingles(template))
            found = wanted & set(own)
            if wanted and 100 * len(found) >= 75 * len(wanted):
                expected.add((str(doc_id), name, len(wanted), len(found), min(own.index(s) for s in found)))
    return sorted(expected)


@pytest.mark.parametrize("literal", [5_000, 1])
def test_license_scans(docs_of, spark, monkeypatch, literal):
    monkeypatch.setattr(licenses, "LITERAL_WINDOWS", literal)
    templates = licenses.TEMPLATES + [("nothing", "..."), ("null", None)]
    rows = odd_documents() + [
        (100 + k, f"{prose(k, 50)}\n{text.upper()} {prose(k + 50, 40)}") for k, (_, text) in enumerate(licenses.TEMPLATES)
    ]
    rows += [(200, licenses.TEMPLATES[5][1].replace("person", "one", 1)), (201, "Licensed under the")]
    frame = spark.createDataFrame(templates, "template string, text string")
    found = licenses.scan_licenses(docs_of(rows), frame).collect()
    own = sorted((str(r.doc_id), r.template, r.n_shingles, r.n_found, r.first_word) for r in found)
    assert own == license_rows(spark, rows, templates)


URLS = [
    "http://example.com/en/1", "https://WWW.Example.com/en/", "http://a.b.example.com/en/x?q=/fr/", "http://example.com/de/",
    "http://x.net/es/y", "http://net/fr/", "ftp://x.net/", "http://example.com", "http://com/", "http://examplecom/", None, "",
    "no scheme/com/", "http://", "://com/a://b", "http://x.com:80/en/#f", "http://example.com./en/", "http://" + "a." * 500 + "com/" + "b/" * 500,
]


def judged_url(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_url_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(url_rules, "BROADCAST_RULES", limit)
    pages = spark.createDataFrame([(i % 15, u, "h") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    found = url_rules.judge_urls(pages, rules).collect()
    own = sorted(map(str, [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in found]))
    assert own == sorted(map(str, [(i % 15, *judged_url(u)) for i, u in enumerate(URLS * 2)]))
    assert url_rules.judge_urls(pages, rules.limit(0)).where("verdict = 'allow' and rule is null").count() == len(found)


def test_rules_without_a_closing_slash(spark):
    pages = spark.createDataFrame([(1, "http://a.com/english"), (2, "http://a.com/de")], "page_id long, url string")
    rules = spark.createDataFrame([("a.com", "/en", "block"), (None, "/", "block")], "host string, path string, verdict string")
    assert {r.page_id: r.verdict for r in url_rules.judge_urls(pages, rules).collect()} == {1: "block", 2: "allow"}


def test_fixity_audit_finds_exactly_the_damage(spark):
    rows = [(i, f"http://h/{i}", "<p>" + "x" * (i % 900 * 20)) for i in range(700)]
    rows += [(None, "http://n", "a"), (5, "http://h/5", "again"), (701, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    records = fixity.placed_records(pages)
    assert fixity.audit(records, fixity.placed_records(pages)).count() == 0
    lost = {255, 699}
    bad = pages.where(~F.col("page_id").isin(*lost) | F.col("page_id").isNull()).withColumn(
        "html", F.when(F.col("page_id").isin(3, 300, 431), F.overlay("html", F.lit("#"), F.lit(1))).otherwise(F.col("html"))
    )
    found = {(r.page_id, r.damage) for r in fixity.audit(records, fixity.placed_records(bad)).collect()}
    expected = {(3, "changed"), (300, "changed"), (431, "changed"), (255, "missing")}
    assert expected <= found
    # What a lost record shifts differs from there to the end of its file, and nothing else.
    assert {p for p, _ in found - expected} <= {699, 701}
    extra = fixity.audit(fixity.placed_records(bad), records).collect()
    assert ("extra", 255) in {(r.damage, r.page_id) for r in extra}
    assert fixity.audit(records.limit(0), records.limit(0)).count() == 0
