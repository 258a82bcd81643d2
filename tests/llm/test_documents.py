"""Quality rules, exact and near copies, personal data, shards, against plain versions."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.llm import exact_dedup, graph, jaccard_join, private_data, quality, sharding

SCHEMA = "doc_id bigint, text string, id string, body string, n bigint, h string, key string, shard int, kept string"


def frame(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", "y", 5, "z", "k", 7, "q") for i, t in rows], SCHEMA).repartition(3)


EDGE = [
    (1, "a b c d e f g h"), (2, None), (3, ""), (None, "a b c d e f g h"), (5, "a b c d e f g h"),
    (5, "a b c d e f g h"), (6, " \n\t "), (7, "ü" * 3000 + " " + "word " * 4000), (None, None), (9, "b a c d e f g h"),
]


def plain_repeats(words, window=8):
    at = collections.defaultdict(list)
    for i in range(len(words) - window + 1):
        at[tuple(words[i : i + window])].append(i)
    return len({j + k for places in at.values() if len(places) > 1 for j in places for k in range(window)})


def test_measurements_equal_plain_counts():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "ab", " ", " ", "\n", "#", "\xa0", "é", "\x1c"]) for _ in range(rng.randint(0, 160)))
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        got = dict(zip(quality.MEASURES.fieldNames(), quality.measure(text, frozenset())))
        assert got["n_words"] == len(words) and got["word_chars"] == sum(map(len, words))
        assert got["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert got["n_dup_lines"] == len(lines) - len(set(lines))
        assert got["n_repeat_words"] == plain_repeats(words)


def test_ledger_policy_and_ablation(spark):
    rows = [*EDGE, (20, "one " * 30), (21, " ".join(f"w{i}" for i in range(40))), (22, " ".join(f"w{i}#" for i in range(40)))]
    ledger = quality.rule_ledger(frame(spark, rows))
    judged = quality.apply_policy(ledger, "v1").collect()
    assert len(judged) == len(rows)
    by = {r.doc_id: r for r in judged}
    assert by[21].kept and not by[22].kept and by[22].failure_bits == 1 << 2
    assert by[20].base_failed and not by[2].kept and by[2].n_words == 0
    base = {r.doc_id: r.kept for r in quality.apply_policy(ledger, "base").collect()}
    assert base[22]
    for r in quality.ablations(ledger, "v1").collect():
        bit = quality.mask_of([r.rule])
        fails = [j for j in judged if j.failure_bits & bit]
        assert r.failed == len(fails)
        assert r.only_here == sum(j.failure_bits == bit for j in judged)
        assert r.kept_without == sum(not j.failure_bits & ~bit for j in judged)
    with pytest.raises(ValueError):
        quality.mask_of(["no such rule"])
    assert quality.rule_ledger(frame(spark, rows).limit(0)).count() == 0
    kept = quality.keep_documents(frame(spark, rows), "v1")
    assert kept.columns == frame(spark, rows).columns and {r.doc_id for r in kept.collect()} == {21}


def test_long_clean_documents_are_kept(spark):
    rng = random.Random(2)
    book = [f"w{int(15_000 ** rng.random())}" for _ in range(400_000)]  # ranks as in prose
    book[::100_000] = ["stupid", "trash.", "loser", "clown"]
    rows = [(1, " ".join(book)), (2, " ".join(["stupid", "trash", "loser", *book[1:2000]])), (3, " ".join(f"v{k % 90}" for k in range(9000)))]
    ledger = {r.doc_id: r for r in quality.rule_ledger(frame(spark, rows)).collect()}
    rule = lambda name: quality.mask_of([name])
    assert 20 * ledger[1].n_distinct_words < ledger[1].n_words and ledger[1].n_toxic_words == 4
    assert not ledger[1].failure_bits & (rule("toxic") | rule("few_distinct_words"))
    assert ledger[2].failure_bits & rule("toxic") and ledger[3].failure_bits & rule("few_distinct_words")


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("keep", ["min", "max"])
def test_exact_groups(spark, keep, weak):
    hash_of = (lambda t: F.unhex(F.md5(F.substring(t, 1, 1)))) if weak else exact_dedup.content_hash
    got = exact_dedup.exact_duplicates(frame(spark, EDGE), keep=keep, hash_of=hash_of).collect()
    groups = collections.defaultdict(list)
    for i, t in EDGE:
        groups[t or ""].append(i)
    want = collections.Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "min" else max)(known) if known else None
        for k, i in enumerate(sorted(ids, key=lambda i: (i is None, i or 0))):
            first = i == best and sorted(ids, key=lambda i: (i is None, i or 0)).index(i) == k
            want[(i, best, len(ids), first, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, got)) == want


def test_dropping_copies_keeps_columns(spark):
    docs = frame(spark, EDGE)
    kept = exact_dedup.drop_exact_duplicates(docs, keep="max")
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in EDGE})
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in parent}


def test_similarity_classes(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = list(EDGE)
    base = [word() for _ in range(120)]
    for k in range(60):  # a large group of near copies, some of them below the threshold
        copy = list(base)
        for _ in range(k % 4):
            copy[rng.randrange(len(copy))] = word()
        rows.append((100 + k, " ".join(copy)))
    rows += [(300 + k, " ".join(word() for _ in range(50))) for k in range(40)]
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 16)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 64)
    got = jaccard_join.similarity_classes(frame(spark, rows)).collect()
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[t or ""].append(i)
    names = list(texts)

    def windows(t):
        w = t.split()
        n = min(5, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()

    sets = [windows(t) for t in names]
    near = [[j for j in range(len(names)) if j != i and sets[i] and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])] for i in range(len(names))]
    want = collections.Counter()
    for i, t in enumerate(names):
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        ids = [x for j in reach for x in texts[names[j]] if x is not None]
        for x in texts[t]:
            want[(x, min(ids) if ids else None, len(near[i]), len(texts[t]))] += 1
    assert collections.Counter(map(tuple, got)) == want
    kept = jaccard_join.drop_near_duplicates(frame(spark, rows))
    assert kept.count() == len({tuple(sorted(c)) for c in (
        tuple(j for j in range(len(names)) if _connected(near, i, j)) for i in range(len(names)))})
    assert jaccard_join.similarity_classes(frame(spark, rows).limit(0)).count() == 0


def _connected(near, i, j):
    reach, todo = {i}, [i]
    while todo:
        for k in near[todo.pop()]:
            if k not in reach:
                reach.add(k)
                todo.append(k)
    return j in reach


def test_a_common_passage_makes_no_large_group_of_candidates(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = [word() for _ in range(40)]
    rows = [(k, " ".join([word() for _ in range(60)] + passage)) for k in range(60)]
    rows += [(100 + k, rows[k][1] + " " + word()) for k in range(5)]
    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    _, texts = jaccard_join.sets_of(frame(spark, rows), "doc_id", "text")
    groups = graph.components(jaccard_join.candidates(texts)).join(texts, F.col("key") == F.col("node"))
    found = collections.defaultdict(set)
    for r in groups.select("root", "rep_id").collect():
        found[r.root].add(r.rep_id)
    assert sorted(map(sorted, found.values())) == [[k, 100 + k] for k in range(5)]


def test_runs_follow_recall():
    assert jaccard_join.runs_needed(1, 0.9) == 3
    assert jaccard_join.runs_needed(2, 0.999) > jaccard_join.runs_needed(1, 0.999)


def plain_spans(text):
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    out = []
    for kind, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (14 <= len(digits) <= 19 and sum(
                    int(d) if k % 2 == 0 else sum(map(int, str(2 * int(d)))) for k, d in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), m.end(), kind))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choice("ab1.2@@+-(%) 3  4445é") for _ in range(60))
        assert private_data.base_spans(text) == plain_spans(text)


CARD, WRONG = "4539578763621486", "7536784127813051"
PRIVATE = [
    (1, "Call +1 (743) 555-3824 now, or (743) 555-3824"), (2, "bob.x@site.com and bob.x (at) site (dot) com"),
    (3, f"{CARD} then {WRONG} {CARD} end"), (4, f"{WRONG} and {WRONG}"), (5, None), (6, ""), (7, "no data"),
    (8, "9.8.7.6 " * 50), (8, "9.8.7.6 " * 50), (None, "a@b.cd"),
]


def test_skip_chain_adds_what_repeats(spark):
    rng = random.Random(2)
    train = []
    for k in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(15))
        card = next(digits + c for c in "0123456789" if private_data.luhn(digits + c))
        wrong = next(digits + c for c in "0123456789" if not private_data.luhn(digits + c))
        train.append((k, f"x{k}@mail.com y +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} z {card} w {wrong} v 1.2.3.{k % 200} and {card} or x{k}@mail.com"))
    field = private_data.fit_field(frame(spark, train))
    assert field.skip > 0
    found = private_data.find_private_data(frame(spark, PRIVATE), field, redacted=True).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(PRIVATE)
    for i, text in PRIVATE:
        base = private_data.spelled(plain_spans(text or ""))
        assert by[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(by[i].spans.split(","))
    assert [by[i].n_added for i in (1, 2, 3, 4, 7)] == [1, 1, 1, 0, 0]
    assert by[1].redacted == "Call [PHONE] now, or [PHONE]" and by[6].redacted == ""
    clean = private_data.redact_documents(frame(spark, PRIVATE), field)
    assert {r.doc_id: r.text for r in clean.collect()}[5] is None
    assert private_data.find_private_data(frame(spark, PRIVATE).limit(0)).count() == 0
    assert private_data.all_spans("call 555 123 4567", private_data.Field.blank()) == []


def test_candidates_are_cut_at_base_spans():
    def loose(text):
        return [text[n.start : n.stop] for n in private_data.nodes_of(text, private_data.base_spans(text)) if not n.label]

    assert loose("555.123.4567 10.0.0.1") == ["555.123.4567"]
    assert loose("(555) 123-4567 4111 1111 1111 1111") == ["(555) 123-4567", "4111 1111 1111 1111"]
    assert loose(f"(555) 123-4567 a {CARD}") == ["(555) 123-4567"]
    assert loose("555 123 4567 555 987 6543 555 000 1111") == ["555 123 4567", "555 987 6543", "555 000 1111"]
    assert loose("bob at site dot com") == [] and loose("bob@site.com bob at site dot com") == ["bob at site dot com"]
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice("12345 -.()+@a") for _ in range(80))
        base = private_data.base_spans(text)
        spans = sorted((n.start, n.stop) for n in private_data.nodes_of(text, base) if not n.label)
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:]))
        assert all(b <= c or d <= a for a, b in spans for c, d, _ in base)


def test_messages_equal_enumerated_marginals():
    """On trees of chain and skip edges message passing is exact."""
    rng, n_labels = np.random.default_rng(3), private_data.N_LABELS
    for _ in range(20):
        n = 5
        field = private_data.Field.blank()
        field.node[:] = rng.normal(size=field.node.shape)
        field.chain[:] = (half := rng.normal(size=field.chain.shape)) + half.T
        field.skip = 2.0
        edges = [(int(rng.integers(0, j)), j) for j in range(1, n)]
        chain, skip = edges[:2], [(i, j, float(rng.uniform(0.5, 1))) for i, j in edges[2:]]
        x, known = rng.normal(size=(n, private_data.N_FEATURES)), np.array([0, 0, 3, 0, 0])
        want, local = np.zeros((n, n_labels)), x @ field.node.T
        for labels in itertools.product(range(n_labels), repeat=n):
            if labels[2] == 3:
                score = sum(local[k, labels[k]] for k in range(n)) + sum(field.chain[labels[i], labels[j]] for i, j in chain)
                score += sum(field.skip * w * (labels[i] == labels[j]) for i, j, w in skip)
                score -= local[2, 3]
                for k in range(n):
                    want[k, labels[k]] += np.exp(score)
        want /= want.sum(axis=1, keepdims=True)
        assert np.abs(field.marginals(x, known, chain, skip) - want).max() < 1e-3


@pytest.mark.parametrize("text, added", [
    ("Call +1 555 123 4567 now. {} the number 123-4567 later", "123-4567"),
    ("Card 4539578763621486 now. {} the number 4539578763621487 later", "4539578763621487"),
    ("Card 4539578763621486 now. {} the number 4539578763621486x 1234 5678 9012 3457", None),
    ("Call +1 555 123 4567 now. {} the number 999-4567 later", None),
])
def test_only_the_skip_edge_decides(small_dir, text, added):
    """Planted numbers far from each other: without skip edges the field adds none of them."""
    text = text.format("w " * 100)
    docs = pd.read_parquet(small_dir.replace("sf0.001", "sf0.1") + "/documents.parquet", columns=["text"]).text.dropna()
    rows = [[], [], [], []]
    for doc in docs[docs.str.contains("[0-9@]")]:
        for part, values in zip(rows, private_data.examples_of(doc)):
            part.extend(values)
    field = private_data.Field.fit(*map(np.array, rows))
    base = private_data.base_spans(text)
    extra = lambda f: [text[a:b] for a, b, k in private_data.all_spans(text, f, base) if (a, b, k) not in base]
    assert added in extra(field) if added else not extra(field)
    field.skip = 0.0
    assert extra(field) == []


def test_held_out_labels_of_the_field(spark, small_dir):
    """Fitted to one half by hash, the field labels base entities of the other half from their looks."""
    docs = spark.read.parquet(small_dir.replace("sf0.001", "sf0.1") + "/documents.parquet")
    field = private_data.fit_field(docs.where("doc_id % 2 = 0"))
    right = wrong = 0
    for row in docs.where("doc_id % 2 = 1 and text rlike '[0-9@]'").collect():
        for node in private_data.nodes_of(row.text, private_data.base_spans(row.text)):
            label = int((field.node @ private_data.features(row.text, node)).argmax())
            right, wrong = right + (label == node.label), wrong + (label != node.label)
    assert right > 0.97 * (right + wrong) and right > 200


@pytest.mark.parametrize("copies", [1, 400])
def test_shards_are_even_and_gapless(spark, copies):
    rng = random.Random(4)
    rows = [(k, "w" * rng.randint(1, 900)) for k in range(1500)] + [(5000 + k, "hot text " * 30) for k in range(copies)]
    rows += [*EDGE[:7], (None, None)]
    got = sharding.shard_records(frame(spark, rows), 6).collect()
    assert len(got) == len(rows)
    want = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(sizes.values()) / 6
    assert len(sizes) == 6 and all(abs(s - mean) < 0.05 * mean for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if copies == 1:
        homes = collections.defaultdict(set)
        for r in got:
            homes[r.text_crc32].add(r.shard)
        assert all(len(h) == 1 for h in homes.values())
    assert sharding.shard_records(frame(spark, rows).limit(0), 6).count() == 0


def test_homes_fill_to_one_level():
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randint(1, 30)
        large = {k: rng.randint(1, 10**6) for k in range(rng.randint(0, 40))}
        total = sum(large.values()) + rng.randint(0, 10**7)
        home, bounds = sharding._homes(large, total, n)
        assert set(home) == {h for h, size in large.items() if size <= -(-total // n)}
        loads = [0.0] * n
        for h, k in home.items():
            loads[k] += large[h]
        fixed, rest = list(loads), total - sum(loads)
        edges = [0, *bounds, rest]
        assert len(bounds) == n - 1 and edges == sorted(edges)
        for k in range(n):
            loads[k] += edges[k + 1] - edges[k]
        level = max([load for load, own in zip(loads, fixed) if load > own + 2], default=0)
        assert all(load >= level - 2 or rest == 0 for load in loads)


@pytest.mark.parametrize("part", [0.05, 0.2, 0.5, 0.95])
def test_equal_texts_up_to_a_shard_stay_together(spark, part):
    """Groups between 1/16 and one shard, beside small ones and one of two and a half shards."""
    rng = random.Random(9)
    plain = ["w" * rng.randint(1, 400) + str(k) for k in range(1200)]
    each = int(sum(map(len, plain)) * part / 6 / 320)
    rows = list(enumerate(plain)) + [(2000 + g * 500 + k, f"group {g} " * 40) for g in range(4) for k in range(each)]
    rows += [(9000 + k, "hot text " * 30) for k in range(600)]
    got = sharding.shard_records(frame(spark, rows), 6).collect()
    sizes, slots, homes = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        homes[r.text_crc32].add(r.shard)
    mean = sum(sizes.values()) / 6
    assert len(got) == len(rows) and len(sizes) == 6 and all(abs(s - mean) < 0.05 * mean for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = zlib.crc32(("hot text " * 30).encode())
    assert all(len(h) == 1 for crc, h in homes.items() if crc != hot)


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    """With two drawn keys per range the first sample leaves ranges overfull; shards stay even and whole."""
    monkeypatch.setattr(sharding, "DRAWS", 2)
    rows = [(k, f"text {k} " * (k % 40 + 1)) for k in range(2000)] + [(None, None), (3000, "")]
    got = sharding.shard_records(frame(spark, rows), 6).collect()
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    mean = sum(sizes.values()) / 6
    assert len(got) == len(rows) and all(abs(s - mean) < 0.02 * mean for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
