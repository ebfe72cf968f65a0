"""Repeated passages, conversation beginnings and periodic runs, against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fabgauge.llm import prefix_trie, runs, substrings
from tests.llm.test_operators import documents

SCHEMA = "doc_id long, text string, lang string, spans string, runs string, digest string, kept string"
TURNS = "conv_id long, turn int, role string, text string, steps string, path string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", "y", "z", None) for i, t in rows], SCHEMA)


def plain_repeats(rows, width):
    """(doc_id, words, removed words, kept text) of each row."""
    owner = {}
    split = [(i, (t or "").split()) for i, t in rows]
    for i, words in split:
        for k in range(len(words) - width + 1):
            if i is not None:
                key = tuple(words[k : k + width])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - width + 1):
            if i is not None and owner[tuple(words[k : k + width])] < i:
                gone |= set(range(k, k + width))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out.append((i, len(words), len(gone), " ".join(kept)))
    return sorted(out, key=repr)


def passages(seed, count, letters=2):
    """Texts that share passages of their own words, with changes."""
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        words = [rng.choice("abcdefgh"[:letters]) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            if texts:
                other = rng.choice(texts).split()
                at = rng.randint(0, len(other))
                words += other[at : at + rng.randint(0, 25)]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("width", [1, 2, 6, 9])
def test_repeats_equal_brute_force(spark, width):
    rows = list(enumerate(passages(width, 150, 8)))
    rng = random.Random(1)
    rng.shuffle(rows)
    rows += [(None, rows[0][1]), (None, None), (400, None), (401, ""), rows[3], (rows[4][0], "a b c d e f g h a b c")]
    found = substrings.remove_repeats(frame(spark, rows), width).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_repeats(rows, width)


def test_repeats_dealt_to_many_tasks_and_shards(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 3)
    monkeypatch.setattr(substrings, "WIDE", 2)
    monkeypatch.setattr(substrings, "SHARD_WORDS", 40)
    line = "one common line of nine words that all share"
    rows = [(k, f"{t} {line} {t[:20]} {line}") for k, t in enumerate(passages(5, 120, 8))]
    for width in (7, 12):
        found = substrings.remove_repeats(frame(spark, rows), width).collect()
        assert sorted((tuple(r) for r in found), key=repr) == plain_repeats(rows, width)


def test_repeats_of_awkward_texts(spark):
    rows = [(r[0], r[1]) for r in documents()]
    found = substrings.remove_repeats(frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == plain_repeats(rows, substrings.WIDTH)
    assert substrings.remove_repeats(frame(spark, [])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), max_size=6), st.integers(1, 6))
def test_automaton_knows_the_smallest_document(texts, width):
    automaton = substrings.Automaton()
    rows = [(k, [b"%d" % w for w in words]) for k, words in enumerate(texts)]
    for k, words in rows:
        automaton.add(words, k)
    for k, words in rows:
        covered = set()
        for at in range(len(words) - width + 1):
            passage = words[at : at + width]
            if any(passage == w[x : x + width] for j, w in rows[:k] for x in range(len(w))):
                covered |= set(range(at, at + width))
        spans = automaton.spans(words, k, width)
        assert covered == {x for a, b in spans for x in range(a, b)}


def plain_trie(conversations):
    """Rows of the trie from (conv_id, list of (role, text))."""
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for node, own in members.items():
        subtree = [n for n in members if n[: len(node)] == node]
        children = [n for n in members if len(n) == len(node) + 1 and n[:-1] == node]
        leaves = [n for n in subtree if not any(len(m) == len(n) + 1 and m[:-1] == n for m in members)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in subtree if n)
        ends = sorted(c for c in own if len(conversations[c]) == len(node))
        rows.append(
            (min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(children), len(leaves),
             saved, sha(",".join(map(str, ends))))
        )
    return sorted(rows, key=repr)


def turn_rows(conversations):
    return [(c, t, r, x, "a", "b") for c, turns in conversations.items() for t, (r, x) in enumerate(turns)]


def plain_rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = conversations.get(c - c % 100, [])[:h] + turns[h:]
    return out


def talk(seed, count):
    rng = random.Random(seed)
    made = {}
    for c in rng.sample(range(1, 900), count):
        made[c] = [(rng.choice(["user", "bot"]), rng.choice(["", "yes", "no é", "x"])) for _ in range(rng.randint(1, 7))]
    made[100] = made[200] = [("user", "hot")] * 6
    return made


@pytest.mark.parametrize("shard_turns", [1, 64])
def test_trie_equals_brute_force(spark, monkeypatch, shard_turns):
    monkeypatch.setattr(prefix_trie, "SPLITTER_TURNS", shard_turns)
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 10)
    made = talk(3, 300)
    steps = prefix_trie.conversation_steps(spark.createDataFrame(turn_rows(made), TURNS))
    for rows, plain in ((steps, made), (prefix_trie.rebuilt(steps), plain_rebuilt(made))):
        found = sorted((tuple(r) for r in prefix_trie.prefix_trie(rows).collect()), key=repr)
        assert found == plain_trie(plain)


def test_trie_of_awkward_conversations(spark):
    rows = [
        (1, None, None, None, "", ""), (1, 0, "user", "b", "", ""), (1, 0, "user", "a", "", ""),
        (1, 0, "user", "a", "", ""), (2, 5, "", "", "", ""), (None, 1, "user", "lost", "", ""),
        (3, 0, "user", "long " * 50_000, "", ""), *[(4, t, "user", "deep", "", "") for t in range(300)],
        *[(5, t, "user", "deep", "", "") for t in range(299)],
    ]
    made = {
        1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], 2: [("", "")], 3: [("user", "long " * 50_000)],
        4: [("user", "deep")] * 300, 5: [("user", "deep")] * 299,
    }
    steps = prefix_trie.conversation_steps(spark.createDataFrame(rows, TURNS))
    found = sorted((tuple(r) for r in prefix_trie.prefix_trie(steps).collect()), key=repr)
    assert found == plain_trie(made)
    none = prefix_trie.conversation_steps(spark.createDataFrame([], TURNS))
    assert prefix_trie.prefix_trie(none).collect() == []


def test_skeleton_is_in_the_splitters(spark):
    steps = prefix_trie.conversation_steps(spark.createDataFrame(turn_rows(talk(4, 400)), TURNS))
    cuts = prefix_trie.splitters(prefix_trie._blocks(steps))
    assert len(cuts) > 3 and cuts == sorted(set(cuts))
    nodes = prefix_trie.skeleton(cuts)
    assert all(nodes[n[:-16]] < k for n, k in nodes.items() if n)
    assert len(nodes) <= 1 + sum(len(c) // 16 for c in cuts)


def plain_runs(words, repeats=4, shortest=6):
    found = []
    for q in range(1, len(words) // repeats + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            part = words[at : at + length]
            smaller = any(part[d:] == part[: length - d] for d in range(1, q))
            if end > at and length >= max(shortest, repeats * q) and not smaller:
                found.append((at, length, q))
            at = max(end, at) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=500, deadline=None)
@given(
    st.lists(st.integers(0, 2), max_size=12),
    st.lists(st.integers(0, 2), min_size=1, max_size=6),
    st.integers(0, 40),
    st.lists(st.integers(0, 2), max_size=30),
    st.sampled_from([2, 3, 4]),
)
def test_runs_equal_brute_force(before, period, length, after, repeats):
    words = [*before, *(period * length)[:length], *after]
    assert runs.runs_of(np.array(words, np.int64), repeats) == plain_runs(words, repeats)


def test_long_runs():
    words = np.random.default_rng(1).integers(0, 3000, 60_000)[np.arange(60_000) % 14_000]
    assert runs.runs_of(words) == [(0, 60_000, 14_000)]
    assert runs.runs_of(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]


def plain_digest(doc_id, text):
    words = (text or "").split()
    found = plain_runs(words)
    kept = [w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in found)]
    best = min(found, key=lambda r: (-(r[1] * 10**9 // r[2]), r[0], r[2])) if found else (None, None, None)
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(kept)),
    )


def planted(doc_id, text):
    words = (text or "").split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i if i < a else a + (i - a) % p] for i in range(n))


def test_run_digests_of_planted_and_awkward_texts(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices("abcdefghij", k=rng.randint(1, 90)))) for k in range(300)]
    rows += [(r[0], r[1]) for r in documents() if r[1] is None or len(r[1]) < 5000]
    found = runs.run_digests(runs.find_runs(runs.with_planted_runs(frame(spark, rows)))).collect()
    expected = [plain_digest(i, planted(i, t)) for i, t in rows]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(expected, key=repr)
    assert sum(r[1] > 0 for r in expected) > 10


def test_runs_of_no_rows_and_a_very_long_text(spark):
    assert runs.run_digests(runs.find_runs(frame(spark, []))).collect() == []
    (row,) = runs.find_runs(frame(spark, [(1, "a b " * 100_000)])).collect()
    assert (row.collapsed, [tuple(r) for r in row.runs]) == ("a b", [(0, 200_000, 2)])
    with pytest.raises(ValueError, match="two periods"):
        runs.find_runs(frame(spark, []), 1)


def test_planted_runs_follow_the_ids(spark):
    rows = [(k, f"w{k} " * 3 + " ".join(str(x) for x in range(k % 40))) for k in range(200)]
    found = runs.with_planted_runs(frame(spark, rows)).select("doc_id", F.trim("text")).collect()
    assert {r[0]: r[1].split() for r in found} == {i: planted(i, t).split() for i, t in rows}
