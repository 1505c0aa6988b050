"""Boilerplate lines against brute force."""

import collections
import random

from hazemart.llm.line_spread import MIN_CHARS, remove_spread_lines


def brute(rows, min_sites, min_chars):
    sites, first = collections.defaultdict(set), {}
    for i, text, site in rows:
        for line in (text.split("\n") if text is not None else []):
            key = line.strip(" ")
            if len(key) >= min_chars:
                if site is not None:
                    sites[key].add(site)
                if i is not None:
                    first[key] = min(first.get(key, i), i)
    out = []
    for i, text, _ in rows:
        lines = text.split("\n") if text is not None else []
        kept = [x for x in lines if i is None or len(x.strip(" ")) < min_chars or len(sites[x.strip(" ")]) < min_sites or first[x.strip(" ")] == i]
        out.append((i, "\n".join(kept) if text is not None else None, len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    draw = random.Random(8)
    shared = [f"shared line number {n} of them all" for n in range(12)]
    rows = []
    for i in range(400):
        site = None if i % 29 == 0 else "hot" if i % 3 == 0 else f"s{draw.randint(0, 12)}"
        lines = [draw.choice(shared[: 1 + i % 12]) if draw.random() < 0.4 else f" own line {i} {n} with some words " for n in range(draw.randint(0, 6))]
        rows.append((None if i % 41 == 0 else i, "\n".join([*lines, "short", ""]) if i % 17 else None if i % 2 else "", site))
    rows += [rows[5], rows[5]]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_removed int").repartition(5)
    found = remove_spread_lines(docs, min_sites=5)
    assert found.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect()), key=str) == brute(rows, 5, MIN_CHARS)


def test_many_sites_are_decided_by_the_sketch(spark):
    rows = [(i, "a line that stands on every single site\nown text of document " + str(i), f"site{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(r.n_removed for r in remove_spread_lines(docs).collect()) == [0] + [1] * 299
    assert remove_spread_lines(docs.limit(0)).count() == 0


def test_short_lines_count_and_blank_ones_stay(spark):
    rows = [(i, f"Les.\n\n \t\nown {i}\nLes. ", f"site{i % 7}") for i in range(14)]
    found = remove_spread_lines(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.doc_id: r.text for r in found} == {i: rows[0][1] if i == 0 else f"\n \t\nown {i}" for i in range(14)}


def test_columns_with_inner_names(spark):
    rows = [(i, f"shared\nown {i}", f"s{i}", i, "x", "y", 3) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _id long, _gone string, _Line string, _first int")
    found = remove_spread_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_removed"]
    assert sorted((r.doc_id, r.text, r._id, r._gone) for r in found.collect()) == [(i, rows[i][1] if not i else f"own {i}", i, "x") for i in range(8)]
