"""Training-data operators on small tables with awkward rows, against brute force or a round trip."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fabgauge.llm import chat, decontaminate, jaccard, languages, neighbours, packing, quality
from fabgauge.llm import sharding, token_files, urls
from fabgauge.llm.common import numbered, scratch, stored, tidy
from fabgauge.llm.tokens import Encoder, default_tokenizer

LONG = "lorem ipsum dolor sit amet " * 40_000
WORDS = [a + b + c for a in ("ba", "no", "ti", "re") for b in ("la", "mu", "so") for c in ("k", "n", "")]


def prose(seed, count):
    return " ".join(random.Random(seed).choices(WORDS, k=count))


def documents():
    """Null, empty, blank, odd, long and repeated texts; near and exact copies."""
    base = prose(1, 120).split()
    near = base[:60] + ["changed"] + base[61:]
    half = base[:60] + prose(2, 60).split()
    texts = [None, "", " \n\t", "!!! ... ---", "Word", "two words", LONG, " ".join(base), " ".join(base).upper(),
             " ".join(near), " ".join(half), "a  b\tc\n\nd", "naïve café — 東京 <|endoftext|> don't 12,5"]
    rows = [(i, t, "en", "src", 1.0) for i, t in enumerate(texts)]
    rows += [(20 + i, prose(i, 3 + 7 * i), ["en", "fr", None][i % 3], None, None) for i in range(30)]
    return [*rows, rows[7], (None, "no id", None, None, None), (None, None, None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, score double"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_ids():
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=150, deadline=None)
@example("1 \t1")
@given(st.text(alphabet=st.sampled_from(list("ab Zé.,'\n\t\u00a0 1東—|<>s")), max_size=40))
def test_ids_by_word_are_those_of_the_whole_text(text):
    if not hasattr(test_ids_by_word_are_those_of_the_whole_text, "made"):
        test_ids_by_word_are_those_of_the_whole_text.made = (Encoder(default_tokenizer(), 5), plain_ids())
    encoder, whole = test_ids_by_word_are_those_of_the_whole_text.made
    assert [*encoder.encode(text).tolist(), 2] == whole(text)


def test_token_files_round_trip(spark, docs, empty):
    folder = scratch(spark, "files")
    token_files.write_token_files(docs, folder, default_tokenizer(), parts=3)
    rows = token_files.read_token_files(spark, folder, with_ids=True).orderBy("start").collect()
    whole, start = plain_ids(), 0
    assert [r.doc_id for r in rows] == sorted((d[0] for d in documents()), key=lambda i: (i is not None, i))
    expected = sorted((d[0] is not None, d[0], whole(d[1])) for d in documents() if d[0] is not None)
    for row in rows:
        assert (row.start, row.n_tokens) == (start, len(row.ids))
        assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        start += row.n_tokens
    assert sorted((True, r.doc_id, r.ids) for r in rows if r.doc_id is not None) == expected
    folder = scratch(spark, "files")
    token_files.write_token_files(empty, folder, default_tokenizer())
    assert token_files.read_token_files(spark, folder).count() == 0


def test_packing_keeps_all_ids(docs, empty):
    pieces = stored(packing.token_pieces(docs, default_tokenizer(), 64, with_ids=True), "pieces")
    packed = packing.pack_pieces(pieces, 64)
    rows = packed.orderBy("sequence_id", "offset").collect()
    assert len(rows) == pieces.count()
    ends = {}
    for r in rows:
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 64
    assert len(ends) <= sum(ends.values()) / 64 * 1.05 + 1
    whole = plain_ids()
    for name, text, *_ in documents():
        if name is not None and name != 7:
            mine = sorted((r.piece, r.start, r.ids) for r in rows if r.doc_id == name)
            assert [i for _, _, ids in mine for i in ids] == whole(text)
            assert all(len(ids) == 64 for _, _, ids in mine[1:])
    sequences = packing.packed_sequences(packed)
    assert sequences.agg(F.sum(F.size("ids"))).first()[0] == sum(ends.values())
    assert packing.pack_documents(empty, default_tokenizer(), 64).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50), max_size=12))
def test_packing_plan_uses_every_piece(counts):
    used = {}
    for contents, times in packing.plan_packing(counts, 32):
        assert sum(contents) <= 32
        for length in contents:
            used[length] = used.get(length, 0) + times
    assert used == counts


def best_fit_sequences(counts, capacity):
    """Plain best fit by decreasing length, piece by piece."""
    rooms = []
    for length in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
        fits = [r for r in rooms if r >= length]
        room = min(fits, default=capacity)
        if fits:
            rooms.remove(room)
        rooms.append(room - length)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.integers(8, 60), st.data())
def test_packing_never_needs_more_than_best_fit(capacity, data):
    counts = data.draw(st.dictionaries(st.integers(1, capacity), st.integers(1, 9), max_size=20))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        histogram[length] = count
    plain = best_fit_sequences(counts, capacity)
    assert sum(n for _, n in packing.best_fit(histogram, capacity)) == plain
    assert sum(n for _, n in packing.plan_packing(counts, capacity)) <= plain


@pytest.mark.parametrize(("folder", "most"), [("sf0.001", 193), ("sf0.01", 964), ("sf0.1", 9871)])
def test_packing_of_the_tables(folder, most):
    path = Path(f"/root/testdata/{folder}/documents.parquet")
    if not path.exists():
        pytest.skip("test tables not present")
    counts = {}
    for ids in Encoder(default_tokenizer()).documents(pq.read_table(path)["text"].to_pylist(), 2):
        first = len(ids) % 1024 or min(1024, len(ids))
        counts[first] = counts.get(first, 0) + 1
        if len(ids) > first:
            counts[1024] = counts.get(1024, 0) + (len(ids) - first) // 1024
    assert sum(n for _, n in packing.plan_packing(counts, 1024)) <= most


def test_packing_replaces_clashing_columns(spark):
    rows = [(k, 0, 1 + k % 7, "a", "b", "c", "d", "e") for k in range(40)]
    names = "doc_id long, piece int, length long, sequence_id string, Offset string, _rank string, _bucket string, _base string"
    packed = packing.pack_pieces(spark.createDataFrame(rows, names), 8)
    assert packed.columns == ["doc_id", "piece", "length", "_rank", "_bucket", "_base", "sequence_id", "offset"]
    assert {r._rank + r._bucket + r._base for r in packed.collect()} == {"cde"}
    ends = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.expr("offset + length")).alias("end"))
    assert ends.filter("n <> end OR n > 8").count() == 0


def test_complements_are_exact():
    assert packing.plan_packing({700: 5, 300: 5, 24: 5}, 1024) == [((700, 300, 24), 5)]
    assert packing.plan_packing({600: 2, 300: 2, 100: 2, 24: 2}, 1024) == [((600, 300, 100, 24), 2)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=25), st.integers(1, 6))
def test_capacity_is_smallest(sizes, shards):
    def needed(capacity):
        count, filled = 1, 0
        for s in sizes:
            if filled + s > capacity:
                count, filled = count + 1, 0
            filled += s
        return count

    best = next(c for c in range(max([0, *sizes]), sum(sizes) + 1) if needed(c) <= shards)
    assert sharding.smallest_capacity(sizes, shards) == best


def test_shards_keep_groups_and_balance(spark, docs, empty):
    rows = sharding.shard_slots(docs, 4).collect()
    assert len(rows) == len(documents())
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert sharding.shard_slots(empty, 4).count() == 0
    many = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "one hot text of a third of all rows")
        .otherwise(F.repeat(F.concat(F.col("id").cast("string"), F.lit("x")), 9))
        .alias("text"),
    )
    found = sharding.shard_slots(many, 8).groupBy("shard").agg(F.sum("size").alias("n"), F.countDistinct("group").alias("g"))
    sizes = sorted((r.n for r in found.collect()), reverse=True)
    assert len(sizes) == 8
    assert sizes[1] - sizes[-1] < 0.02 * sizes[1] + 100
    assert sharding.shard_slots(many, 8).groupBy("group").agg(F.countDistinct("shard").alias("s")).filter("s > 1").count() == 0


def test_numbers_have_no_gaps(spark):
    rows = stored(spark.range(500).select(F.when(F.col("id") < 400, "hot").otherwise("cold").alias("g"), "id"), "rows")
    found = numbered(rows, ["g"], ["id"], "n").collect()
    assert sorted(r.n for r in found if r.g == "hot") == list(range(400))
    assert sorted(r.n for r in found if r.g == "cold") == list(range(100))


def brute_components(rows):
    sets = {}
    for name, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        width = min(5, len(words))
        sets[name] = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set()
    reach = {n: n for n in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]) and reach[a] != reach[b]:
                    reach[a] = reach[b] = min(reach[a], reach[b])
                    changed = True
    return {n: (len(sets[n]), reach[n]) for n in sets}


def test_components_equal_brute_force(spark, docs, empty):
    found = jaccard.jaccard_components(docs).collect()
    assert len(found) == len(documents())
    expected = brute_components([(d[0], d[1]) for d in documents() if d[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    assert {r.component_id for r in found if r.doc_id is None} == {None}
    assert jaccard.jaccard_components(empty).count() == 0


@pytest.mark.parametrize("choice", ["none", "all", "odd"])
def test_no_choice_of_common_tokens_loses_a_link(spark, docs, monkeypatch, choice):
    """The sample only orders tokens: without one, and with made-up counts of any tokens, the links are all there."""
    tokens = np.unique(np.concatenate([jaccard.shingles(d[1]) for d in documents()]))
    tokens = {"none": tokens[:0], "all": tokens, "odd": tokens[1::2]}[choice]
    counts = np.random.default_rng(5).integers(1, 9000, len(tokens))
    monkeypatch.setattr(jaccard, "common_tokens", lambda rows: (tokens, counts))
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect() if r.doc_id is not None}
    assert found == brute_components([(d[0], d[1]) for d in documents() if d[0] is not None])


def test_near_copies_of_every_closeness(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "RARE", 2)
    monkeypatch.setattr(jaccard, "CELL_TOKENS", 300)
    monkeypatch.setattr(jaccard, "CELL_QUERIES", 3)
    rows = []
    for k in range(6):
        base = prose(100 + k, 90).split()
        for v in range(12):
            copy = list(base)
            for place in random.Random(v).sample(range(90), v // 2):
                copy[place] = f"x{k}{v}{place}"
            rows.append((len(rows), " ".join(copy) + " a passage that very many of the documents share"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert found == brute_components(rows)


def test_one_of_each_group_stays(docs):
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    names = [r.doc_id for r in kept.collect()]
    assert 7 in names and not {8, 9} & set(names) and 10 in names
    assert names.count(7) == 1 and names.count(None) == 2


def test_one_of_each_group_stays_with_clashing_columns(spark, docs):
    named = docs.withColumnsRenamed({"lang": "_key", "source": "_digest", "score": "_new"})
    kept = jaccard.keep_first(named)
    assert kept.columns == named.columns
    plain = sorted(map(repr, (tuple(r) for r in jaccard.keep_first(docs).collect())))
    assert sorted(map(repr, (tuple(r) for r in kept.collect()))) == plain


def test_every_text_of_a_repeated_id_is_judged(spark):
    a, b, c, d, e = (prose(300 + k, 60) for k in range(5))
    rows = [(1, a), (5, a), (5, b), (2, c), (2, d), (3, c), (4, d), (3, c), (6, e), (6, e), (9, ""), (9, None), (None, a)]
    kept = jaccard.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted((r.doc_id or 0, r.text or "") for r in kept)
    assert found == sorted([(0, a), (1, a), (5, b), (2, c), (2, d), (6, e), (9, "")])


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_histogram_never_hides_a_link(one, two):
    def tokens(values):
        return np.unique(np.array([hash((v, "t")) % 2**64 for v in values], np.uint64))

    a, b = tokens(one), tokens(two)
    if jaccard.linked(a, b):
        sizes = (len(a), len(b))
        assert jaccard.may_link(jaccard.histogram(a).tobytes(), jaccard.histogram(b).tobytes(), sizes)


def test_leaks_with_replaced_words(spark, docs, empty):
    item = prose(50, 40)
    replaced = item.split()
    replaced[::7] = ["other"] * len(replaced[::7])
    benchmark = spark.createDataFrame(
        [(1, item, "x"), (1, item, "x"), (2, "too short", None), (3, None, None), (None, item, None), (4, prose(51, 30), "y")],
        "item_id long, text string, source string",
    )
    texts = {
        100: prose(60, 80) + " " + item + " " + prose(61, 9),
        101: (prose(62, 10) + " -- " + " ".join(replaced)).upper(),
        102: prose(63, 200),
        103: item[: len(item) // 2] + " " + prose(64, 30),
        104: prose(65, 5) + " " + " ".join(item.split()[:6]) + " " + prose(66, 40),
    }
    leaky = spark.createDataFrame(
        [*((k, v, None, None, None) for k, v in texts.items()), (100, texts[100], None, None, None)], SCHEMA
    )
    found = decontaminate.find_contamination(docs.unionByName(leaky), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(100, 1), (101, 1), (103, 1)}
    whole = next(r for r in found if r.doc_id == 100)
    assert (whole.equal_words, whole.first_word) == (40, 80)
    kept = decontaminate.remove_contaminated(docs.unionByName(leaky), benchmark)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() + 2
    assert decontaminate.find_contamination(empty, benchmark).count() == 0
    nothing = benchmark.limit(0)
    assert decontaminate.remove_contaminated(docs, nothing).count() == docs.count()


def plain_leaks(texts, items):
    """(doc_id, item_id, most equal words, first of them) by laying every item at every place."""
    found = set()
    for d, text in texts.items():
        words = text.split()
        for i, item in items.items():
            ways = []
            wanted = item.split()
            width = min(decontaminate.WINDOW, len(wanted))
            for shift in range(1 - len(wanted), len(words)):
                same = [0 <= shift + k < len(words) and words[shift + k] == w for k, w in enumerate(wanted)]
                if any(sum(same[k : k + width]) >= width * decontaminate.SHARE for k in range(len(wanted) - width + 1)):
                    ways.append((sum(same), shift + same.index(True)))
            if ways:
                found.add((d, i, max(w[0] for w in ways), min(w[1] for w in ways)))
    return found


def test_leaks_of_long_items_equal_brute_force(spark):
    rng = random.Random(8)
    items = {n: " ".join(rng.choices("abcdefghijklmnopqrst"[: rng.choice([3, 8, 20])], k=n)) for n in range(15, 61, 5)}
    texts = {}
    for d in range(60):
        words = rng.choices("abcdefghijklmnopqrst", k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 2)):
            copy = rng.choice(list(items.values())).split()
            copy = copy[rng.randint(0, 5) : rng.randint(10, 60)]
            for k in range(len(copy)):
                if rng.random() < 0.2:
                    copy[k] = rng.choice("xyz")
            words += copy + rng.choices("uvw", k=rng.randint(0, 6))
        texts[d] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontaminate.find_contamination(docs, benchmark).collect()
    expected = plain_leaks(texts, items)
    assert {tuple(r) for r in found} == expected and len(expected) > 20


def test_leaks_of_very_repetitive_texts(spark):
    phrase = "one two three four five "
    rows = [(1, phrase * 40_000), (2, "again " * 60_000), (3, " ".join(f"w{k}" for k in range(50_000)))]
    benchmark = spark.createDataFrame([(1, phrase * 8), (2, "again " * 40)], "item_id long, text string")
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string")
    start = time.time()
    found = decontaminate.find_contamination(docs, benchmark).collect()
    assert {tuple(r) for r in found} == {(1, 1, 40, 0), (2, 2, 40, 0)}
    assert time.time() - start < 120


def accepted_patterns(size, least_only=False):
    """Bits of the equal words of items of a size, for all ways that the rule accepts."""
    width = min(decontaminate.WINDOW, size)
    need = -int(-width * decontaminate.SHARE // 1)
    for bits in range(1 << size):
        most = max((bits >> s & (1 << width) - 1).bit_count() for s in range(size - width + 1))
        if most >= need and not (least_only and bits.bit_count() > need):
            yield bits


@pytest.mark.parametrize("size", range(1, 16))
def test_masks_hit_every_accepted_pattern(size):
    masks = decontaminate.MASKS[min(size, decontaminate.WINDOW)]
    placed = [int(m, 2) << s for m in masks for s in range(size - len(m) + 1)]
    assert all(any(bits & p == p for p in placed) for bits in accepted_patterns(size))


def test_leaks_of_short_items(spark):
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 13)}
    texts, expected = [], set()
    for n, words in items.items():
        for bits in accepted_patterns(n, least_only=True):
            copy = [w if bits >> k & 1 else "other" for k, w in enumerate(words)]
            expected.add((len(texts), n, bits.bit_count()))
            texts.append(" ".join(["before", *copy, "after"]))
            if n > 1:  # one equal word less
                copy[copy.index(next(w for w in copy if w != "other"))] = "other"
                texts.append(" ".join(["before", *copy, "after"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chosen in (list(items), [12]):
        benchmark = spark.createDataFrame([(n, " ".join(items[n])) for n in chosen], "item_id long, text string")
        found = decontaminate.find_contamination(docs, benchmark).collect()
        mine = {(r.doc_id, r.item_id, r.equal_words) for r in found}
        assert mine == {e for e in expected if e[1] in chosen}


def test_conversations_round_trip(spark):
    nasty = "<|im_start|>user\n<|im_sep|> <\\|im_end|>\\ [INST] <<SYS>> </s>"
    rows = [
        (1, 2, "assistant", nasty, 0), (1, 1, "user", "hi", 0), (1, 3, "assistant", "more\n", 0),
        (1, 4, None, None, 0), (1, 5, "assistant", "", 0), (2, 1, "odd\nrole\\n", LONG, 0),
        (2, 1, "odd\nrole\\n", LONG, 0), (None, None, "user", "no ids", None), (3, 1, "assistant", "東京 \\", 1),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    formatted = chat.format_conversations(turns)
    read = {r.conv_id: r for r in chat.read_conversations(formatted).collect()}
    digests = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    assert set(read) == {1, 2, 3, None}
    for conv in read:
        mine = sorted(
            ((r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        )
        assert [(t.role, t.text) for t in read[conv].turns] == [m[1:] for m in mine]
        text = "".join(f"{role}\n{said}\n" for _, role, said in mine)
        assert digests[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        loss = "".join(said for _, role, said in mine if role == "assistant")
        assert digests[conv].loss_chars == len(loss)
        assert digests[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert digests[conv].formatted_chars == len(read[conv].formatted)
        assert "".join(s.text for s in read[conv].segments) == read[conv].formatted
    assert read[1].formatted.count(chat.START) == 4
    assert chat.conversation_digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_neighbours_equal_brute_force(spark):
    random_ = np.random.default_rng(0)
    centres = random_.normal(size=(6, 8))
    vectors = [(i, (centres[i % 6] + 0.2 * random_.normal(size=8)).tolist(), i) for i in range(900)]
    vectors += [(1000 + i, vectors[0][1], 0) for i in range(300)]
    odd = [(2000, None, 0), (2001, [1.0, None], 0), (2002, [float("nan")] * 8, 0), (2003, [float("inf")] * 8, 0),
           (None, [1.0] * 8, 0), (2050, [], 0), (2100, [3.0, 1.0], 0), vectors[50]]
    table = spark.createDataFrame([*vectors, *odd], "vec_id long, embedding array<float>, score int")
    whole = neighbours.integer_vectors(table, "vec_id", "embedding")
    found = {}
    for r in neighbours.top_inner_products(whole, F.col("id") % 50 == 0, 5).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    ints = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v, _ in vectors}
    ints |= {2050: np.zeros(8, int), 2100: np.array([768, 256, 0, 0, 0, 0, 0, 0])}
    assert set(found) == {i for i in ints if i % 50 == 0}
    for q in found:
        scores = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)[:5]
        assert [found[q][k + 1] for k in range(5)] == [(i, -s) for s, i in scores]
    few = neighbours.integer_vectors(table.filter("vec_id IN (50, 51, 52)"), "vec_id", "embedding")
    assert neighbours.top_inner_products(few, F.col("id") == 50, 5).count() == 2
    none = neighbours.integer_vectors(table.limit(0), "vec_id", "embedding")
    assert neighbours.top_inner_products(none, F.col("id") == 50, 5).count() == 0


def test_quality_learns_and_scores_every_row(spark, docs, empty):
    good = [(1000 + i, prose(i, 60), None, None, None) for i in range(60)]
    bad = [(2000 + i, " ".join(w + "$$$" for w in prose(i, 60).split()), None, None, None) for i in range(60)]
    table = docs.unionByName(spark.createDataFrame(good + bad, SCHEMA))
    marks = [(r[0], int(r[0] < 2000)) for r in good + bad if r[0] % 3] + [(5, None), (None, 1), (9999, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, label int")
    rows = quality.score_quality(table, labels).collect()
    assert len(rows) == table.count()
    assert all(0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.doc_id and r.doc_id >= 1000 and r.doc_id % 3 == 0]
    assert all((r.score >= 0.5) == (r.doc_id < 2000) for r in unseen)
    one = quality.score_quality(docs, labels.filter("label = 1")).select("score").distinct().collect()
    assert len(one) == 1 and one[0].score > 0.5
    assert quality.score_quality(docs, labels.limit(0)).first().score == 0.5
    assert quality.score_quality(empty, labels).count() == 0


def test_languages(spark, docs, empty):
    english = "the house that stands by the river was built with stone and wood"
    french = "la maison qui est au bord de la rivière était bâtie en pierre et en bois"
    rows = [(i, t, n, None, None) for i, (t, n) in enumerate([(english, "en"), (french, "fr")] * 20)]
    known = spark.createDataFrame(rows, SCHEMA)
    profiles = languages.learn_profiles(known.unionByName(docs.filter("lang IS NULL")))
    assert set(profiles) == {"en", "fr"}
    asked = spark.createDataFrame(
        [(1, "the stone by the river", "fr", None, 9.0), (2, "au bord de la maison", None, None, None),
         (3, None, "en", None, None), (4, "12 + 3 ...", "en", None, None), (5, "", None, None, None), (6, LONG, None, None, None)],
        SCHEMA,
    )
    found = {r.doc_id: r for r in languages.identify_languages(asked, profiles).collect()}
    assert (found[1].lang_pred, found[2].lang_pred) == ("en", "fr")
    assert [(found[k].lang_pred, found[k].score) for k in (3, 4, 5)] == [("und", 0.0)] * 3
    assert all(0 <= r.score <= 1 for r in found.values()) and found[6].lang_pred in profiles
    assert languages.identify_languages(asked, {}).select("lang_pred").distinct().collect()[0][0] == "und"
    assert languages.learn_profiles(empty) == {}
    assert languages.identify_languages(empty, profiles).count() == 0


def brute_rule(url, rules):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1], match[2]) if match else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best and best.verdict


def test_urls(spark):
    rules = [urls.Rule.parse(t) for t in ("allow org/", "block example.org/es/", "block com/de/", "allow com/fr/")]
    texts = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/1", "x://org", "x://org/", "x://borg/",
             "http://a.b.org/x?y=://c.com/de/", "http://É.com/de/#t", "a://b://c.com/fr/", "http://u@h.org:8/x\ny"]
    texts += [f"http://site{i}.example.org/es/spam-{i}" for i in range(40)] + [f"http://good{i}.net/page" for i in range(40)]
    texts += [f"http://fine{i}.org/page/{i}" for i in range(40)] + ["http://example.net/es/spam-77" + "z" * 50_000]
    rows = [(i, t, "old", 1) for i, t in enumerate(texts)] + [(0, None, "old", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, ratio int")
    found = urls.judge_urls(pages, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path, rule, verdict = brute_rule(texts[r.page_id], rules)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    ratio = {r.page_id: r.ratio for r in found}
    assert ratio[texts.index("http://fine3.org/page/3")] > ratio[texts.index("http://site3.example.org/es/spam-3")]
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge_urls(pages, []).collect()} == {"allow"}


def brute_ratios(labelled, asked):
    """Log ratios with counts kept by the context itself."""
    counts = {}

    def grams(url):
        signs = [None] * urls.ORDER + list((url or "").lower().encode()) + ["end"]
        return [[tuple(signs[at - k : at]) for k in range(urls.ORDER + 1)] + [signs[at]] for at in range(urls.ORDER, len(signs))]

    for url, accepted in labelled:
        for *contexts, sign in grams(url):
            for context in contexts:
                followers = counts.setdefault((accepted, context), {})
                followers[sign] = followers.get(sign, 0) + 1
    found = {}
    for url in asked:
        total, places = 0.0, grams(url)
        for *contexts, sign in places:
            chance = [1 / 257, 1 / 257]
            for context in contexts:
                for c in (0, 1):
                    followers = counts.get((c, context), {})
                    chance[c] = (followers.get(sign, 0) + chance[c]) / (sum(followers.values()) + 1)
            total += np.log(chance[1]) - np.log(chance[0])
        found[url] = total / len(places)
    return found


@pytest.mark.parametrize("frequent", [100_000, 300])
def test_url_ratios_equal_counts_without_hashing(spark, monkeypatch, frequent):
    monkeypatch.setattr(urls, "FREQUENT", frequent, raising=False)
    letters = random.Random(3)
    made = ["".join(letters.choices("abcdefghijklmnopqrstuvwxyz0123456789\x01é", k=24)) for _ in range(1500)]
    texts = [f"http://x.{('org', 'com', 'net')[i % 3]}/{m}" for i, m in enumerate(made)] + [None, "", "http://x.net/hot"]
    rules = [urls.Rule.parse("allow org/"), urls.Rule.parse("block com/")]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9000 + i, texts[-1]) for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    held_out = {r.url for r in pages.filter(f"pmod(xxhash64(url), {urls.HELD_OUT}) = 0").collect()}
    labelled = [(t, int(".org/" in t)) for t in texts if t and not t.startswith("http://x.net") and t not in held_out]
    expected = brute_ratios(labelled, set(texts))
    found = urls.judge_urls(pages, rules).collect()
    assert sorted(r.page_id for r in found) == sorted(r[0] for r in rows)
    assert max(abs(r.ratio - expected[r.url]) for r in found) < 1e-8


def appended_coordinate_descent(rows, labels, ratio, floor):
    """The same steps with all scaled values made beforehand."""
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([np.mean(labels == label) for label in (0, 1)])
    cost, weights = quality.COST * 0.5 / share[labels], np.zeros(quality.WIDTH + 1)
    values = [np.append(quality.scaled(row, ratio, floor), 1.0) for row in rows]
    places = [np.append(row, quality.WIDTH) for row in rows]
    alpha, chance = np.zeros(len(rows)), np.random.default_rng(0)
    for _ in range(quality.EPOCHS):
        for i in chance.permutation(len(rows)):
            gradient = signs[i] * (weights[places[i]] @ values[i]) - 1.0
            new = min(max(alpha[i] - gradient / (values[i] @ values[i]), 0.0), cost[i])
            weights[places[i]] += (new - alpha[i]) * signs[i] * values[i]
            alpha[i] = new
    return weights


def test_quality_fit_holds_no_values_beside_the_rows():
    chance = np.random.default_rng(5)
    rows = [np.sort(chance.choice(quality.WIDTH, 5000, replace=False)).astype(np.int32) for _ in range(200)]
    labels = np.arange(200) % 2
    ratio = quality.log_count_ratio(rows, labels)
    tracemalloc.start()
    weights = quality.dual_coordinate_descent(rows, labels, ratio, 0.5)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Beside the weights; scaled values and places of all rows would be 16 MB.
    assert most - 2 * weights.nbytes < 3_000_000
    assert np.array_equal(weights, appended_coordinate_descent(rows, labels, ratio, 0.5))


def test_a_task_gives_free_memory_back():
    resident = lambda: int(Path("/proc/self/statm").read_text().split()[1]) * 4096
    last = []

    def work(batches):
        rows = [np.ones(1000) for _ in range(20_000)]
        last.append(np.ones(1000))  # stays behind the others, so nothing before it is given back by itself
        yield from batches
        rows.clear()

    before = resident()
    assert list(tidy(work)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 60_000_000


def test_an_encoder_keeps_few_words_between_tasks():
    encoder, whole = Encoder(default_tokenizer(), 40), plain_ids()
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100))
    for _ in range(3):
        assert [x.tolist() for x in encoder.documents([text])] == [whole(text)]
        assert len(encoder.cache) + len(encoder.older) > 10
        encoder.shrink(10)
        assert 0 < len(encoder.cache) + len(encoder.older) <= 10
