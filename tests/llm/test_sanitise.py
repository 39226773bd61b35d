"""Base spans against plain patterns; disclosure on a corpus with known answers."""

import collections
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pulsepanel.llm import registry, sanitise

PATTERNS = [
    re.compile(p)
    for p in (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    )
]


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = (
                kind == 0
                or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                or kind == 2 and 14 <= len(digits) <= 19 and luhn(digits)
                or kind == 3 and 10 <= len(digits) <= 15
            )
            if fine:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("ab@.-+ 0123456789()é٣"), max_size=60))
def test_base_spans_are_the_patterns(text):
    assert sanitise.base_spans(text) == plain(text)


def test_card_numbers():
    assert sanitise.base_spans("pay 4111-1111 1111 1111 now") == [(4, 2, 23)]
    assert sanitise.base_spans("pay 4111-1111 1111 1112 now") == []
    assert sanitise.base_spans("1" * 5000 + ".1.1.1") == []


def test_query_has_the_base_spans(spark, sf_dir, documents):
    rows = {r.doc_id: r for r in registry.QUERIES["op4_disclosure"](spark, sf_dir).collect()}
    for d in documents.collect():
        spans = plain(d.text or "")
        listed = [f"{sanitise.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        row = rows[d.doc_id]
        assert [s for s in row.spans.split(",") if s and not s.startswith("term")] == listed
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            sum(k == i for _, k, _ in spans) for i in range(4)
        )
        assert row.base_sha256 == __import__("hashlib").sha256(",".join(listed).encode()).hexdigest()


def corpus(spark):
    rows = [(i, f"note {i} says Zorblax writes from z@x.org about lunch today") for i in range(6)]
    rows += [(10 + i, f"note {i} says she writes from home about lunch today") for i in range(200)]
    rows += [(300, "nobody but zorblax knows"), (301, "lunch was fine"), (302, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_reveal_an_address(spark):
    docs = corpus(spark)
    rows = {r.doc_id: r.spans for r in sanitise.report(docs).collect()}
    marked = {d: [s for s in spans.split(",") if s.startswith("term")] for d, spans in rows.items()}
    # the name stands in the six notes and once alone: it gives the address away wherever it is
    assert marked[300] == ["term:11:18"] and marked[0] == ["term:12:19"]
    assert marked[301] == [] and not any(marked[10 + i] for i in range(200))
    texts = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert "orblax" not in texts[300].lower() and texts[301] == "lunch was fine" and texts[302] is None
    assert "[EMAIL]" in texts[0] and "z@x.org" not in texts[0] and "lunch today" in texts[0]


def test_one_text_is_no_evidence(spark):
    docs = spark.createDataFrame(
        [(i, "Zorblax writes from z@x.org") for i in range(9)] + [(20 + i, f"other {i}") for i in range(50)],
        "doc_id long, text string",
    )
    assert not any("term" in r.spans for r in sanitise.report(docs).collect())


def marked_words(spark, rows):
    """The words marked as terms, by row."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    out = {}
    for r in sanitise.report(docs).collect():
        places = [s.split(":")[1:] for s in r.spans.split(",") if s.startswith("term")]
        out.setdefault(r.doc_id, []).extend(texts[r.doc_id][int(a) : int(b)].lower() for a, b in places)
    return out


def test_two_texts_are_enough_and_one_is_not(spark):
    others = [(100 + i, f"she writes from home about lunch number {i % 40} of {i}") for i in range(3000)]
    rows = [(1, "Zorblax writes from z@x.org"), (2, "lunch with Quibbly of q@x.org"), (3, "Quibbly writes home, q@x.org")]
    rows += [(10 + i, "number of Wimbrel is w@x.org") for i in range(50)]
    # the name part of an address is one more text for the words that it spells
    rows += [(4, "Drumlin and plover signed: drumlin.k7@x.org"), (5, "she writes home: she@x.org")]
    got = marked_words(spark, rows + others)
    assert got[1] == [] and "quibbly" in got[2] and got[3] == ["quibbly"]
    assert got[4] == ["drumlin"] and got[5] == []
    # copies count once: neither more evidence, nor less
    assert not any(got[10 + i] for i in range(50))
    assert not any(got[100 + i] for i in range(3000))


def test_same_counts_same_decision_in_any_corpus(spark):
    policy = sanitise.Policy()
    counts = [(1, 1), (2, 2), (2, 3), (4, 5), (3, 10), (6, 6), (12, 12), (100, 100)]
    pairs = spark.createDataFrame([(b, t, b) for b, t in counts], "b long, t long, e long")
    shares = [
        [r[0] for r in pairs.select(sanitise.disclosed(pairs.b, pairs.t, pairs.e, n, policy)).collect()]
        for n in (10**4, 10**6, 10**10)
    ]
    assert shares[0] == shares[1] == shares[2]
    assert [s >= policy.generalise for s in shares[0]] == [False, True, False, True, False, True, True, True]
    assert [s >= policy.remove for s in shares[0]] == [False] * 6 + [True, True]


def plain_terms(rows, policy=sanitise.Policy()):
    """Revealing terms by plain counts over the distinct texts."""
    texts = {t for _, t in rows if t is not None} | ({""} if any(t is None for _, t in rows) else set())
    words = {t: {m[0].lower() for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", t)} for t in texts}
    n_term, n_entity, n_both, spelled = (collections.Counter() for _ in range(4))
    for t in texts:
        n_term.update(words[t])
        spans = plain(t)
        values = {(k, t[a:b].lower() if k < 2 else re.sub("[^0-9]", "", t[a:b])) for a, k, b in spans}
        n_entity.update(values)
        blank = list(t)
        for a, _, b in spans:
            blank[a:b] = "@" * (b - a)
        free = set()
        for m in re.finditer("[0-9A-Za-z\x80-\U0010ffff]+", t):
            if "@" not in blank[m.start() : m.end()]:
                free.add(m[0].lower())
        n_both.update((v, w) for v in values for w in free)
    out = {}
    for (v, w), both in n_both.items():
        name = re.findall("[a-z\x80-\U0010ffff]{2,}", v[1].split("@")[0]) if v[0] == 0 else ()
        both, n = both + (w in name), n_term[w] + (w in name)
        p, z = min(both / n, 1), policy.z
        low = (p + z * z / 2 / n - z * math.sqrt(p * (1 - p) / n + z * z / 4 / n / n)) / (1 + z * z / n)
        content = min(math.log(len(texts) / n_entity[v]), math.log(policy.crowd))
        share = 1 + math.log(low) / content if content > 0 else 0
        out[w] = max(out.get(w, 0), share)
    return {w for w, share in out.items() if share >= policy.generalise}


def planted(seed=5):
    """Texts of frequent and rare words; 40 persons with an address each, named in one to six of its texts."""
    rng = random.Random(seed)
    rare = iter(range(10**6))
    words = lambda n: [f"w{int(rng.paretovariate(0.6))}" for _ in range(n)] + [f"rare{next(rare)}"]
    rows = [(i, " ".join(words(30))) for i in range(1500)]
    for p in range(40):
        name = "".join(rng.choices("bdgklmnprstvz", k=8))
        for k in range(1 + p % 6):
            text = words(25)
            text.insert(rng.randrange(len(text)), name.capitalize())
            text.insert(rng.randrange(len(text)), f"box{p}x@mail{p % 3}.org")
            rows.append((2000 + 10 * p + k, " ".join(text)))
        yield name, 1 + p % 6, rows
        rows = []


def test_planted_names_precision_and_recall(spark):
    names, rows = {}, []
    for name, n, more in planted():
        names[name] = n
        rows += more
    terms = {w for found in marked_words(spark, rows).values() for w in found}
    assert terms == plain_terms(rows)
    often = {name for name, n in names.items() if n >= 2}
    assert often <= terms  # recall 1 for names in two texts or more
    assert len(terms & set(names)) >= 0.9 * len(terms)
    assert not any(w.startswith("rare") for w in terms)


def test_directory_of_many_addresses(spark, monkeypatch):
    monkeypatch.setattr(sanitise, "BLOCK", 4)
    page = " ".join(f"a{i}@x.org" for i in range(40)) + " Quibbly and others"
    rows = [(1, page), (2, f"{page} again"), (3, "Quibbly: a1@x.org a2@x.org a7@x.org"), (4, "a7@x.org Quibbly")]
    rows += [(10 + k, f"Brontly{k} " + " ".join(f"a{i}@x.org" for i in range(k, 40, 3))) for k in range(3)]
    rows += [(100 + i, f"others and she writes again {i}") for i in range(400)]
    terms = {w for found in marked_words(spark, rows).values() for w in found}
    assert terms == plain_terms(rows) and "quibbly" in terms


def test_terms_far_from_the_address(spark):
    far = " ".join(f"word{i}" for i in range(60))
    near = [(i, f"Zorblax {far} z@x.org" if i % 2 else f"z@x.org asks Zorblax {far}") for i in range(12)]
    rows = near + [(100 + i, f"{far} she writes {i}") for i in range(500)]
    got = marked_words(spark, rows)
    assert all("zorblax" in got[i] for i in range(12)) and not any(got[100 + i] for i in range(500))


def test_odd_rows(odd_documents, no_documents):
    rows = sanitise.report(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert [(r.n_email, r.n_phone) for r in rows if r.doc_id == 8] == [(1, 1)]
    out = sanitise.sanitise(odd_documents)
    assert out.columns == odd_documents.columns and out.count() == odd_documents.count()
    assert sanitise.report(no_documents).count() == 0 and sanitise.sanitise(no_documents).count() == 0
