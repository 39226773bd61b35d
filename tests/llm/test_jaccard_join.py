"""The join against brute force over all pairs."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsepanel.llm import jaccard_join as jj
from pulsepanel.llm import registry
from pulsepanel.llm.words import mixed


def brute(rows, k, percent):
    """doc key -> (size, least doc_id of the component) from all pairs."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        size = min(k, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def result(df, k, percent):
    rows = jj.near_duplicates(df, k, percent).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from([70, 80, 90, 95]), st.integers(1, 300), st.integers(1, 10**9), st.data())
def test_linked_sets_share_a_signature(percent, size, sets, data):
    """For every allocation: whatever the differences, the pair meets in a segment."""
    r = random.Random(data.draw(st.integers(0, 10**6)))
    a = mixed(np.array(r.sample(range(10**6), size), np.uint64))
    most = jj.most_different(size, percent)
    gone = r.randint(0, min(most, size - 1))
    new = mixed(np.array(r.sample(range(10**6, 2 * 10**6), r.randint(0, most - gone)), np.uint64))
    b = np.unique(np.concatenate([a[gone:], new]))
    a = np.unique(a)
    if not jj.linked(a, b, percent):
        return
    edges = jj.band_edges(max(len(a), len(b)), percent)
    for without_empty in (None, percent):
        seen = []
        for s in (a, b):
            seen.append(set())
            for band in jj.bands_of(len(s), edges, percent):
                shape = jj.allocate(edges[band], edges[band + 1], percent, sets)
                seen[-1] |= {(band, x) for x in jj.signatures(s, band, shape, without_empty).tolist()}
        assert seen[0] & seen[1]


@pytest.mark.parametrize("shape", [(40, 0, 60), (40, 20, 30), (40, 36, 0), (400, 30, 60), (4000, 0, 950)])
def test_sets_without_empty_segments_still_meet(shape):
    """Also where many segments are empty, of both kinds, with as many differences as a link allows."""
    high, single, whole = shape
    r = np.random.default_rng(high + single)
    band = jj.Band(high // 2, high, single, whole)
    cut = 0
    for _ in range(300):
        size = int(r.integers(high // 2, high))
        a = np.unique(r.integers(0, 1 << 63, size, dtype=np.uint64))
        most = jj.most_different(size, 80)
        gone = int(r.integers(0, most + 1))
        new = r.integers(0, 1 << 63, int(r.integers(0, most - gone + 1)), dtype=np.uint64)
        b = np.unique(np.concatenate([a[r.permutation(len(a))[gone:]], new]))
        if len(b) >= high or not jj.linked(a, b, 80):
            continue
        mine, other = jj.signatures(a, 3, band, 80), jj.signatures(b, 3, band, 80)
        assert len(np.intersect1d(mine, other))
        cut += len(mine) < len(jj.signatures(a, 3, band))
    assert cut


def test_unrelated_sets_seldom_meet_by_chance():
    r = np.random.default_rng(5)
    band = jj.allocate(243, 475, 80, 10**6)
    sets = [np.unique(r.integers(0, 1 << 63, int(n), dtype=np.uint64)) for n in r.integers(243, 475, 400)]

    def met(percent):
        found = np.concatenate([np.unique(jj.signatures(s, 4, band, percent)) for s in sets])
        return int((np.unique(found, return_counts=True)[1] - 1).sum())

    assert met(80) * 10 < met(None)


def test_allocation_follows_cost():
    few, many = jj.allocate(10, 14, 90, 10), jj.allocate(10, 14, 90, 10**9)
    assert few.single == 0 and many.single > 0
    for band in (few, many):
        assert band.whole + 2 * band.single > jj.most_different(13, 90)


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_given_documents(documents, k, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(documents, k, percent) == brute(rows, k, percent)


def test_query_is_the_contract(spark, sf_dir, documents):
    got = registry.QUERIES["op3_universe_partition"](spark, sf_dir).collect()
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows, 3, 90)


def test_chains_and_groups_of_near_copies(spark):
    """Copies around one text at all distances, and chains whose ends are not linked."""
    r = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = base[:]
        for _ in range(r.randint(0, 5)):
            words[r.randrange(60)] = f"x{r.randrange(40)}"
        rows.append((i, " ".join(words)))
    for i in range(30):  # each shares most with the next
        rows.append((200 + i, " ".join(f"c{j}" for j in range(2 * i, 2 * i + 45))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(df, 3, 90) == brute(rows, 3, 90)


def test_odd_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert result(odd_documents, 3, 90) == brute(rows, 3, 90)
    assert jj.near_duplicates(no_documents).count() == 0
    kept = jj.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    keys = [(r.doc_id, (r.text or "")[:9]) for r in kept.collect()]
    assert sorted(keys, key=str) == sorted(
        [(1, "a short t"), (1, "another t"), (2, ""), (3, ""), (None, "a text wi"), (None, ""), (4, " \t\n\r\x0b\x0c "),
         (5, "word0 Oth"), (7, "a" * 9), (8, "café ☃ \U0001f600 "), (9, "same word")],
        key=str,
    )


@pytest.mark.parametrize("block", [1, 3, 8, 4096])
@pytest.mark.parametrize("strays", [0, 1, 9])
def test_blocks_of_a_hub_lose_no_pair(spark, block, strays):
    """A group of one component, strays of their own and a second hub, dealt to blocks of any size."""
    r = random.Random(block + strays)
    rows = []
    for hub, size in ((1, 40), (2, 5)):
        base = set(r.sample(range(10_000), 100))
        for i in range(size + strays):
            own = set(r.sample(sorted(base), 95)) | set(r.sample(range(20_000, 30_000), r.choice([3, 60])))
            label = 7 if hub == 1 and i < size else 1000 * hub + i
            rows.append((hub, 100 * hub + i, label, own))
    table = [
        (h, c, label, len(s), bytes(jj.parity_sketch(np.array(sorted(s), np.uint64), 1 << 9)))
        for h, c, label, s in rows
    ]
    members = spark.createDataFrame(table, "hub bigint, class bigint, label bigint, n int, sketch binary")
    got = {(p.a, p.b) for p in jj._apart(members, 80, False, block).collect()}
    sketch = {c: np.frombuffer(x, np.uint8) for _, c, _, _, x in table}
    want = set()
    for h, c, label, n, _ in table:
        for h2, c2, label2, n2, _ in table:
            differ = int(np.bitwise_count(sketch[c] ^ sketch[c2]).sum())
            if h == h2 and c < c2 and label != label2 and 180 * differ <= 20 * (n + n2):
                want.add((c, c2))
    assert got == want and bool(want)
