"""Repeated passages against a plain search for 50-word windows."""

from __future__ import annotations

import collections
import random

import pytest

from lexmill.llm import suffix_dedup
from tests.llm.test_documents import EDGE, frame


def plain(rows):
    """Runs of words covered by 50-word windows that another document has too."""
    docs = {(i, t or ""): (t or "").split() for i, t in rows}
    where = collections.defaultdict(set)
    for key, words in docs.items():
        for at in range(len(words) - 49):
            where[tuple(words[at : at + 50])].add((key, at))
    covered = collections.defaultdict(set)
    for places in where.values():
        if len({key for key, _ in places}) > 1:
            for key, at in places:
                covered[key].add(at)
    out = collections.Counter()
    for (i, _), starts in covered.items():
        run = None
        for at in sorted(starts):
            if run and at <= run[1]:
                run[1] = at + 50
            else:
                if run:
                    out[i, run[0], run[1] - run[0]] += 1
                run = [at, at + 50]
        out[i, run[0], run[1] - run[0]] += 1
    return out


@pytest.mark.parametrize("together", [20_000, 6])
def test_passages_equal_plain_search(spark, monkeypatch, together):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    words = lambda n: [word() for _ in range(n)]
    shared = [words(n) for n in (49, 50, 51, 55, 80, 300)]
    rows = list(EDGE)
    for k in range(40):
        text = words(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(shared) + words(rng.randint(0, 30))
        rows.append((100 + k, " ".join(text)))
    rows += [(200, " ".join(shared[4] + words(9) + shared[4])), (201, "same " * 300), (202, "same " * 200 + "end"), (203, " ".join(shared[5]))]
    rows += [(300 + k, " ".join(words(k % 13) + shared[3] + words(40))) for k in range(30)]
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    got = suffix_dedup.repeated_passages(frame(spark, rows)).collect()
    want = plain(rows)
    mine = collections.Counter((r.doc_id, r.start_word, r.n_words) for r in got)
    if together > 1000:
        assert mine == want
    else:  # in a large alike group a run may reach less far than with a partner that was dealt elsewhere
        assert {(i, a) for i, a, _ in mine} <= {(i, a + d) for i, a, n in want for d in range(n)}
        assert {i for i, _, _ in mine} == {i for i, _, _ in want}
    assert all(r.other_id != r.doc_id or r.doc_id in (5, None) for r in got)
    assert suffix_dedup.repeated_passages(frame(spark, rows).limit(0)).count() == 0


def test_positions_of_very_long_texts():
    rng = random.Random(1)
    codes = suffix_dedup.word_codes(" ".join(rng.choice("abcdefghij") for _ in range(150_000)))
    kept, _ = suffix_dedup.kept_positions(codes)
    assert max(b - a for a, b in zip(kept, kept[1:])) <= suffix_dedup.WINDOW
    assert len(kept) < 0.1 * len(codes)


@pytest.mark.parametrize("together", [2, 6, 20])
def test_crowded_stems_lose_no_passage(spark, monkeypatch, together):
    rng = random.Random(together)
    words = lambda n: ["".join(rng.choice("abcdef") for _ in range(4)) for _ in range(n)]
    line = words(40)  # alone too short to count
    rows = [(k, " ".join(words(k % 9) + line + words(60))) for k in range(80)]
    for k in range(20):  # pairs share 10 to 15 words more, before or behind
        more = words(10 + k % 6)
        both = more + line if k % 2 else line + more
        rows += [(1000 + 2 * k + i, " ".join(words(30 + i) + both + words(30))) for i in range(2)]
    rows += [(2000 + k, " ".join(words(k) + line + line[:25] + words(20))) for k in range(9)]
    rows += [(None, rows[100][1]), (3000, rows[100][1]), (3000, rows[100][1])]
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    got = suffix_dedup.repeated_passages(frame(spark, rows)).collect()
    assert collections.Counter((r.doc_id, r.start_word, r.n_words) for r in got) == plain(rows)
    assert all(r.other_id != r.doc_id for r in got)
