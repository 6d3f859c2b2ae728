import random
import re

import pytest

from grantline.llm import groups
from grantline.llm.neardup import _cells, near_duplicates, one_per_group, trees_for

SCHEMA = "doc_id long, text string, low string, cell long"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, percent):
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def corpus(seed, n_groups, copies, edits):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    rows, number = [], 0
    shared = " ".join(rng.choices(vocabulary, k=60))
    for _ in range(n_groups):
        base = rng.choices(vocabulary, k=rng.randint(30, 150))
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((number, " ".join(words) + (f" {shared}" if rng.random() < 0.5 else "")))
            number += 1
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)


def result(spark, rows, **settings):
    found = near_duplicates(frame(spark, rows), **settings).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in found}, found


@pytest.mark.parametrize(
    "seed, settings",
    [
        (1, {}),
        (2, {"cell_rows": 6, "hubs": 3}),  # many nodes are large: hubs, slices and children
        (3, {"cell_rows": 4, "hubs": 8, "max_depth": 0}),  # nodes shrink by their hubs alone
    ],
)
def test_components_equal_brute_force(spark, seed, settings):
    rows = corpus(seed, 4, 12, 6)
    got, _ = result(spark, rows, percent=80, **settings)
    assert got == brute(rows, 80)


def test_threshold_is_inclusive_and_exact(spark):
    words = [f"w{n}" for n in range(41)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(words[:36])), (4, " ".join(words[:33]))]
    got, _ = result(spark, rows, percent=85)
    assert got == brute(rows, 85)


def test_edge_cases(spark):
    long = " ".join(f"w{n % 977}x{n % 13}" for n in range(60_000))
    rows = [(5, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "ONE  two"), (10, "one two three"), (11, long), (12, long + " end"),
            (13, "a b c d e f"), (13, "a b c d e f"), (None, "a b c d e f")]
    got, found = result(spark, rows, percent=80)
    assert got[5] == (0, 5) and got[6] == (0, 6) and got[7] == (0, 7)
    assert got[9] == (1, 8) and got[10] == (1, 10)
    assert got[12][1] == 11
    assert sum(r.doc_id == 13 for r in found) == 2 and got[13] == (2, 13)
    alone = next(r for r in found if r.doc_id is None)
    assert alone.component_id is None and alone.kept is False
    kept = one_per_group(frame(spark, rows), near_duplicates(frame(spark, rows)))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [5, 6, 7, 8, 10, 11, 13]
    assert kept.where("doc_id IS NULL").count() == 1 and kept.columns == frame(spark, rows).columns


def test_every_large_node_has_a_hub_in_every_draw(spark):
    # 150 nodes of 20 texts that are not linked: two hubs are expected in each, so by chance some have none.
    rows = [(node, 100 * node + i, 2000, 8) for node in range(150) for i in range(20)]
    frontier = spark.createDataFrame(rows, "node long, id long, n long, depth int")
    found = [
        {(r.node, r.id) for r in _cells(frontier, None, 4, 1, *draw).where("is_hub").select("node", "id").distinct().collect()}
        for draw in ((), (1,))
    ]
    assert all({node for node, _ in hubs} == set(range(150)) for hubs in found)
    assert found[0] != found[1]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tree_count_follows_the_recall():
    assert trees_for(0.8, 1e-6) > trees_for(0.8, 1e-3) > trees_for(0.95, 1e-3)


def test_connected_components_of_paths_and_stars(spark):
    links = [(n, n + 1) for n in range(100, 160)] + [(900, n) for n in range(500, 560)] + [(7, 7)]
    found = dict(map(tuple, groups.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert {found[n] for n in range(100, 161)} == {100}
    assert {found[n] for n in range(500, 560)} == {500} and found[900] == 500


def test_rows_that_repeat_an_id_with_other_texts(spark):
    words = [f"w{n}" for n in range(60)]
    rows = [(0, " ".join(words)), (1, " ".join(words[:-1])), (1, "quite another text of several words here"),
            (2, "quite another text of several words here"), (3, "alone in the world with seven words"), (3, "ALONE in the world with seven words")]
    frame_of = frame(spark, rows)
    found = near_duplicates(frame_of, percent=80)
    got = sorted((r.doc_id, r.component_id, r.kept) for r in found.collect())
    assert got == [(0, 0, True), (1, 0, False), (1, 1, True), (2, 1, False), (3, 3, True), (3, 3, True)]
    kept = sorted(map(tuple, one_per_group(frame_of, found).select("doc_id", "text").collect()))
    assert kept[:2] == [(0, rows[0][1]), (1, rows[2][1])] and [d for d, _ in kept] == [0, 1, 3]


def test_further_links_cost_rounds_of_their_own_only(spark, monkeypatch):
    """Links in three portions give the components of all of them; a portion that joins two components is not a rerun."""
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(240)]
    contracted, whole = [], groups.components

    def noted(given):
        contracted.append(given.count())
        return whole(given)

    monkeypatch.setattr(groups, "components", noted)
    joined = None
    for portion in (links[:150], links[150:230], links[230:]):
        joined = groups.further_components(joined, spark.createDataFrame(portion, "a long, b long"))
    expected = whole(spark.createDataFrame(links, "a long, b long"))
    assert sorted(map(tuple, joined.where("id <> component").collect())) == sorted(map(tuple, expected.where("id <> component").collect()))
    assert joined.select("id").distinct().count() == joined.count()
    assert contracted == [150, 80, 10]
