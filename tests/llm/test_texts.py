"""Operators on texts against plain versions of themselves."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path as vocabulary_path
from samples import documents, prose, texts
from tokenizers import Tokenizer

from carelake.llm import chosen_path, chunked_bpe, kdtree, packing, pseudo_likelihood, suffix_dedup, suffixes, toxicity


def repeats(rows, length=50):
    """What op4 should say of each (doc_id, text), in order."""
    first = {}
    for i, t in rows:
        data = (t or "").encode()
        for k in range(len(data) - length + 1):
            if i is not None:
                first[data[k:k + length]] = min(i, first.get(data[k:k + length], i))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - length + 1):
            if i is not None and first[data[k:k + length]] < i:
                gone[k:k + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("large", [20_000, 2])
def test_repeated_strings_go(spark, monkeypatch, large):
    monkeypatch.setattr(suffix_dedup, "LARGE", large)  # 2: every group is split down to single strings
    got = suffix_dedup.deduplicated(documents(spark)).collect()
    assert ordered(got) == ordered(repeats(texts()))


def test_frequent_passages_go_too(spark):
    rng = random.Random(5)
    passage = prose(rng, 25)
    rows = [(i, prose(rng, rng.randint(0, 15)) + " " + passage + " " + prose(rng, rng.randint(0, 15))) for i in range(60)]
    assert ordered(suffix_dedup.deduplicated(documents(spark, rows)).collect()) == ordered(repeats(rows))


def test_contexts_of_one_id_stay_apart(spark):
    """Two contexts whose ids are equal by chance: neither takes the other's bytes, document or mask."""
    rng = np.random.default_rng(2)
    a, b = (bytes(rng.integers(97, 123, 60, dtype=np.uint8)) for _ in range(2))
    rows = [(1, a, 12), (2, a, 12), (1, b, 14), (3, a[:55] + b[55:], 12)]
    contexts = spark.createDataFrame(
        [(d, 0, 7, c, o, 11) for d, c, o in rows], "doc_id long, start int, context_id long, context binary, offset int, n int"
    )
    distinct = suffix_dedup._distinct(contexts)
    assert {(r["doc"], bytes(r["context"]), r["offset"]) for r in distinct.collect()} == {(1, a, 12), (1, b, 14), (3, rows[3][1], 12)}
    masks = suffix_dedup._earlier(distinct, 50).join(
        distinct.select("*", suffix_dedup._check()), ["context_id", "check"]).collect()
    # of document 3 the first 6 strings end within the 55 bytes that document 1 has too
    assert [(r["doc"], r["mask"]) for r in masks] == [(3, 0b111111)]


@pytest.mark.parametrize("hot", [16, 4_000_000])
def test_grams_of_few_percent_of_the_documents_are_split(spark, monkeypatch, hot):
    """A passage in 4 % of the documents is frequent once that is many documents; the result is the same."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(8)
    passage = prose(rng, 30)
    rows = [(i, prose(rng, 25) + (" " + passage if i % 25 == 3 else "") + " " + prose(rng, 5)) for i in range(600)]
    table = documents(spark, rows)
    frequent = suffix_dedup._frequent(suffix_dedup._rows(table), len(rows), 50)
    assert (len(frequent) > 0) == (hot == 16)
    assert ordered(suffix_dedup.deduplicated(table).collect()) == ordered(repeats(rows))


def test_remaining_text_keeps_whole_characters(spark):
    got = suffix_dedup.deduplicated(documents(spark), texts=True, columns=("lang", "slot")).collect()
    assert {r["text"] for r in got if r["doc_id"] == 401} == {None}
    assert all(r["text"] is not None for r in got if r["doc_id"] != 401)
    assert {r["slot"] for r in got} == {"l"}


def test_anchors_of_texts_that_follow_each_other():
    """They are those of each text alone, and no string spans two texts."""
    rng = random.Random(4)
    texts = [prose(rng, rng.choice([0, 1, 9, 40, 200])).encode() for _ in range(60)]
    texts += [b"a" * 300, b"", b"\x00\xff" * 40, texts[3], texts[-1][:49], b"x" * 50]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    cuts = np.cumsum([0, *map(len, texts)])
    anchors = suffixes.Anchors(50, 20)
    text, gram, at, start, n = anchors.of_texts(data, cuts)
    contexts = anchors.context_ids(data, at, start, n)
    strings = {}
    for i, d in enumerate(texts):
        own = text == i
        alone = anchors(d)
        for together, one in zip((gram[own], at[own] - cuts[i], start[own] - cuts[i], n[own]), alone):
            assert (together == one).all()
        assert (contexts[own] == anchors.context_ids(d, *alone[1:])).all()
        assert alone[3].sum() == max(0, len(d) - 49)
        for g, a, s, k in zip(*(x.tolist() for x in alone)):
            for j in range(s, s + k):  # equal strings have one anchor at one place
                assert strings.setdefault(d[j:j + 50], (g, a - j)) == (g, a - j) and 0 <= a - j <= 30


def test_batches_are_cut_into_texts_that_bits_can_number():
    batch = pa.RecordBatch.from_arrays([pa.array([b"%d" % i for i in range(40_000)])], names=["data"])
    cut = list(suffix_dedup._few([batch]))
    assert [len(b) for b in cut] == [16_384, 16_384, 7_232]
    found = [(low, bytes(d), c.tolist()) for b in cut for low, d, c in suffix_dedup._plain(b.column("data"))]
    assert b"".join(d for _, d, _ in found) == b"".join(b"%d" % i for i in range(40_000))
    assert sum(len(c) - 1 for _, _, c in found) == 40_000 and all(c[0] == 0 and c[-1] == len(d) for _, d, c in found)
    assert max(len(d) for _, d, _ in found) <= suffix_dedup.TOGETHER


def test_numbers_come_back_from_their_planes():
    for kind in (np.int64, np.uint32, np.uint8):
        values = [np.array(v, dtype=kind) for v in ([1, 200, 3], [], [7])]
        column = pa.chunked_array([pa.array([suffix_dedup._planes(v) for v in values], type=pa.binary())])
        assert suffix_dedup._numbers(column, kind).tolist() == [1, 200, 3, 7]
    assert suffix_dedup._numbers(pa.chunked_array([], type=pa.binary()), np.int64).tolist() == []


def test_groups_of_one_document_are_not_sorted():
    group, doc = np.array([5, 5, 9, 9, 9, -1]), np.array([1, 1, 4, 2, 4, 3])
    assert suffix_dedup._shared(group, doc).tolist() == [False, False, True, True, True, False]


def test_values_are_sought_in_sorted_ones():
    known = np.array([3, 7, 7, 2**64 - 1], dtype=np.uint64)
    values = np.array([0, 3, 4, 7, 8, 2**64 - 1], dtype=np.uint64)
    assert suffix_dedup._held(values, known).tolist() == [False, True, False, True, False, True]
    assert not suffix_dedup._held(values, known[:0]).any()


def test_multikey_order_sorts():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 3, (5000, 7)).astype(np.uint64)
    assert (rows[suffixes.multikey_order(rows)] == rows[np.lexsort(rows.T[::-1])]).all()


def shingles(text):
    words = (text or "").split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_similar_documents(spark):
    rows = texts()
    sets = [shingles(t) for _, t in rows]
    links = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    expected = []
    for a, (i, _) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        low = min((rows[b][0] for b in seen), key=lambda v: (v is None, v or 0))
        expected.append((i, low, len(links[a]), i == low))
    got = chosen_path.similar(documents(spark)).select("doc_id", "class_id", "n_links", "kept").collect()
    assert ordered(got) == ordered(expected)
    kept = chosen_path.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({i for i, low, _, _ in expected if i == low and i is not None} | {None})


@pytest.mark.parametrize("small", [8, 2])
def test_similar_documents_in_split_buckets(spark, monkeypatch, small):
    monkeypatch.setattr(chosen_path, "SMALL", small)
    monkeypatch.setattr(chosen_path, "BLOCK", small)
    rng = random.Random(3)
    base = prose(rng, 120).split()
    rows = [(i, " ".join(base[:k] + [f"w{i}"] + base[k + 1:])) for i, k in enumerate(rng.choices(range(120), k=40))]
    rows += [(100 + i, prose(rng, 50) + " " + " ".join(base[:30])) for i in range(40)]
    sets = [shingles(t) for _, t in rows]
    expected = [sum(a != b and len(x & y) >= 0.8 * len(x | y) for b, y in enumerate(sets)) for a, x in enumerate(sets)]
    got = {r["doc_id"]: r["n_links"] for r in chosen_path.similar(documents(spark, rows)).collect()}
    assert [got[i] for i, _ in rows] == expected


ODD = ["<|endoftext|>a b", "it's  I'LL\u00a0we've", "a\u0301 e\u0301\u0301", "Σας İstanbul ǅ", "\u2003x\x1cy", "日本語テキスト" * 40, "!" * 900, "a" * 2000, "\t \n", "1234567 x2y"]


def test_encoding_equals_the_tokenizer(spark):
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    rng = random.Random(9)
    odd = [" ".join(rng.choices(ODD, k=30)) for _ in range(30)] + ["".join(rng.choices(ODD, k=30)) for _ in range(30)]
    rows = texts() + [(1000 + i, t) for i, t in enumerate([*ODD, *odd, *odd[:5]])]
    got = chunked_bpe.encode(documents(spark, rows), vocabulary_path("word_bpe_49k.json"), full=True).collect()
    expected = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        plain, decoded = " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(plain.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), plain, decoded))
    assert ordered(got) == ordered(expected)


def test_chunks_join_to_the_text():
    for t in [*ODD, *(t or "" for _, t in texts())]:
        assert "".join(chunked_bpe.chunks(t)) == t


def test_chunks_have_a_longest_length(spark):
    rng = np.random.default_rng(4)
    letters = "".join(rng.choice(list("abcdefgh "), 30_000))
    for t in ("a" * 50_000, "é" * 20_000, "\U0001f642" * 9_000, letters, letters + "a" * 10_000 + letters):
        own = chunked_bpe.chunks(t)
        assert "".join(own) == t and max(len(c.encode()) for c in own) <= chunked_bpe.LONGEST
    rows = [(i, "a" * 50_000 + " b" * 3_000) for i in range(3)] + [(3, "é" * 20_000), (4, " " * 9_000 + "x")]
    shared = chunked_bpe.shared_chunks(documents(spark, rows), vocabulary_path("word_bpe_49k.json"), 6_000)
    assert sum(len(c.encode()) for c in shared) <= 6_000
    got = chunked_bpe.encode(documents(spark, rows), vocabulary_path("word_bpe_49k.json"), full=True).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    for r in got:
        assert r["ids"] == " ".join(map(str, tokenizer.encode(rows[r["doc_id"]][1], add_special_tokens=False).ids))


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError):
        chunked_bpe.Encoder(vocabulary_path("byte_bpe_50k.json"))
    assert not chunked_bpe.parts_at_spaces(Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json")))
    assert chunked_bpe.parts_at_spaces(Tokenizer.from_file(vocabulary_path("word_bpe_49k.json")))


def test_shards_have_near_equal_bytes(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(20, 60))) for i in range(800)] + [(2000 + i, "same text " * 20) for i in range(400)]
    got = kdtree.shard(documents(spark, [*rows, (5000, None), (5001, ""), (None, "x")]), 8).collect()
    assert len(got) == 1203
    weight, slots = Counter(), defaultdict(list)
    for r in got:
        weight[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean = sum(weight.values()) / 8
    assert set(weight) == set(range(8)) and max(abs(w - mean) for w in weight.values()) < 0.05 * mean + 500
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5000]["size"] == 16 and by_id[5000]["text_crc32"] == 0
    assert by_id[3]["text_crc32"] == zlib.crc32(rows[3][1].encode())


def least_padding(lengths, buckets):
    values = sorted(set(lengths))
    count = Counter(lengths)
    best = {0: 0}
    for _ in range(buckets):
        best = {j: min(best[i] + sum(count[v] * (values[j - 1] - v) for v in values[i:j]) for i in best if i < j)
                for j in range(1, len(values) + 1) if any(i < j for i in best)} | {0: 0}
    return best[len(values)]


@pytest.mark.parametrize("seed", range(5))
def test_buckets_are_optimal(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(0, 30) for _ in range(60)]
    values = sorted(set(lengths))
    count = Counter(lengths)
    for k in (1, 2, 4, 40):
        found = packing.boundaries(
            np.array(values), np.array([count[v] for v in values]), np.array([v * count[v] for v in values]), k)
        assert found.padding == least_padding(lengths, k)
        assert sum(min(x for x in found.lengths if x >= v) - v for v in lengths) == found.padding
        assert sum(found.counts) == len(lengths)


def test_buckets_of_long_texts_are_optimal(spark):
    rng = random.Random(2)
    lengths = [rng.randint(8192, 8222) for _ in range(60)]
    found = packing.fit(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"), 4)
    assert found.padding == least_padding(lengths, 4)
    assert sum(min(x for x in found.lengths if x >= n) - n for n in lengths) == found.padding


def test_batches_hold_the_budget(spark):
    got = packing.pack(documents(spark), buckets=4, budget=300).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in texts())
    batches = defaultdict(list)
    for r in got:
        assert r["n_tokens"] <= r["bucket_length"]
        batches[r["bucket"], r["batch"]].append(r)
    for rows in batches.values():
        assert len(rows) * rows[0]["bucket_length"] <= 300 or len(rows) == 1
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert {r["doc_id"]: r["n_tokens"] for r in got}[401] == 0


def test_scores_sum_conditional_log_probabilities(spark):
    docs = documents(spark)
    known = pseudo_likelihood.vocabulary(pseudo_likelihood.word_counts(docs))
    ids = pseudo_likelihood.encoded(docs.filter("doc_id = 3"), known)
    network = pseudo_likelihood.fit(ids, rounds=1)
    (n,), (total,) = pseudo_likelihood.log_likelihoods(ids.toArrow().to_batches()[0], network)
    line = [0, 0, *pseudo_likelihood.token_ids(dict(texts())[3], known)[0].tolist(), 0, 0]
    plain = 0.0
    for k in range(2, len(line) - 2):
        h = np.tanh(sum(network.context[o][line[k + d]] for o, d in enumerate((-2, -1, 1, 2))) + network.bias)
        a, b = divmod(line[k], pseudo_likelihood.SIDE)
        p = np.exp(h @ network.first + network.first_bias)
        q = np.exp(np.tanh(h + network.digit[a]) @ network.second + network.second_bias[a])
        plain += np.log(p[a] / p.sum()) + np.log(q[b] / q.sum())
    assert n == len(line) - 4 and total == pytest.approx(plain, rel=1e-4)


def test_training_helps_and_every_row_is_scored(spark):
    rng = random.Random(8)
    fixed = " ".join(WORD * 3 for WORD in ("ab", "cd", "ef", "gh"))
    rows = [(i, " ".join([fixed] * 40)) for i in range(30)] + [(100, " ".join(rng.sample(fixed.split() * 40, 160))), (101, None), (102, " ")]
    got = {r["doc_id"]: r for r in pseudo_likelihood.score(documents(spark, rows)).collect()}
    assert len(got) == 33 and got[101]["n_tokens"] == 0 and got[101]["per_token"] is None and got[102]["log_likelihood"] == 0
    assert got[0]["per_token"] > got[100]["per_token"]
    assert got[0]["log_likelihood"] == pytest.approx(got[1]["log_likelihood"])


@pytest.mark.parametrize("held", [20, 65_536])
def test_every_word_has_its_own_probability(spark, monkeypatch, held):
    rng = random.Random(4)
    often = [f"w{k}" for k in range(300)]
    rows = [(i, " ".join(rng.sample(often, 100))) for i in range(60)]
    rows += [(1000, "seldom seldom seldom"), (1001, "once"), (1002, "z" * 300), (1003, "w1"), (1004, "É é w1 \u2003 w2"), (None, "seldom once")]
    docs = documents(spark, rows)
    counts = pseudo_likelihood.word_counts(docs)
    known = pseudo_likelihood.vocabulary(counts, common=10, groups=7, held=held)
    n = Counter(w for _, t in rows for w in t.lower().split())
    assert {r["word"]: r["n"] for r in counts.collect()} == n
    ranked = sorted(n.keys() - {"z" * 300}, key=lambda w: (-n[w], w))
    assert list(known.place) == ranked[:len(known.place)] and 10 <= len(known.place) <= held and (held < 300 or len(known.place) == len(ranked))
    own = set(ranked[:10])
    totals = Counter()
    for w in n.keys() - own:
        totals[zlib.crc32(w.encode()) % 7] += n[w]
    for w in n:
        (i,), share, rest = pseudo_likelihood.token_ids(w, known)
        share += sum(k * np.log(n[x]) for x, k in rest.items())
        assert share == pytest.approx(0 if w in own else np.log(n[w] / totals[i - 11]))
    assert len({int(pseudo_likelihood.token_ids(w, known)[0][0]) for w in own}) == 10

    network = pseudo_likelihood.Network.new()
    monkeypatch.setattr(pseudo_likelihood, "fit", lambda ids, rounds: network)
    monkeypatch.setattr(pseudo_likelihood, "vocabulary", lambda counts: known)
    scores = {r["doc_id"]: r["log_likelihood"] for r in pseudo_likelihood.score(docs).collect()}
    assert len(scores) == len(rows)
    for i, t in rows:
        ids, share, rest = pseudo_likelihood.token_ids(t, known)
        line = np.concatenate([[0, 0], ids, [0, 0]]).astype(np.int64)
        at = np.arange(2, len(line) - 2)
        plain = network.log_probability(pseudo_likelihood._near(line, at), line[at]).sum()
        assert scores[i] == pytest.approx(plain + share + sum(k * np.log(n[x]) for x, k in rest.items()), rel=1e-4)


def test_probabilities_of_all_ids_sum_to_one():
    rng = np.random.default_rng(2)
    network = pseudo_likelihood.Network.new()
    network = network.with_vector(network.vector() + rng.standard_normal(network.vector().size) / 5)
    near = np.repeat(rng.integers(0, pseudo_likelihood.SIZE, (4, 1)), pseudo_likelihood.SIZE, axis=1)
    each = np.exp(network.log_probability(near, np.arange(pseudo_likelihood.SIZE)).astype(np.float64))
    assert each.sum() == pytest.approx(1, abs=1e-4)


def test_the_network_learns_along_the_gradient():
    rng = np.random.default_rng(1)
    network = pseudo_likelihood.Network.new()
    token = rng.integers(0, pseudo_likelihood.SIZE, 64)
    near = rng.integers(0, pseudo_likelihood.SIZE, (4, len(token)))
    for name, rows, g in list(network.gradient(near, token)):
        w = getattr(network, name)
        w = w.reshape(-1, w.shape[-1]) if rows is not None else w
        index = (0 if rows is None else rows[0], *[0] * (w.ndim - 1)) if w.ndim > 1 else (0,)
        was, loss = w[index], []
        for step in (1e-2, -1e-2):
            w[index] = was + step
            loss.append(-network.log_probability(near, token).astype(np.float64).mean())
        w[index] = was
        assert g[(0,) * g.ndim] == pytest.approx((loss[0] - loss[1]) / 2e-2, abs=2e-4), name


def test_every_position_is_trained_on_once(spark, monkeypatch):
    seen = []
    docs = documents(spark)
    ids = pseudo_likelihood.encoded(docs, pseudo_likelihood.vocabulary(pseudo_likelihood.word_counts(docs)))
    inner = pseudo_likelihood._trained

    def noted(ids, start, *args):
        seen.append(args)
        return inner(ids, start, *args)

    monkeypatch.setattr(pseudo_likelihood, "_trained", noted)
    pseudo_likelihood.fit(ids.limit(3))
    assert len(seen) == 3
    for batch in ids.toArrow().to_batches():
        line, begins, sizes = pseudo_likelihood._laid_out(batch)
        trained = np.concatenate([pseudo_likelihood._positions(begins, sizes, turn, rounds) for turn, rounds, _ in seen])
        inside = [k for b, s in zip(begins, sizes) for k in range(b, b + s)]
        assert sorted(trained) == inside


def test_a_text_of_one_word_is_learnt_wherever_it_lies(spark):
    def first_biases(texts):
        docs = documents(spark, list(enumerate(texts))).coalesce(1)
        known = pseudo_likelihood.vocabulary(pseudo_likelihood.word_counts(docs))
        return pseudo_likelihood.fit(pseudo_likelihood.encoded(docs, known), rounds=1).first_bias

    untrained = pseudo_likelihood.Network.new().first_bias
    assert not np.allclose(first_biases([""] * 3 + ["alone"]), untrained)
    assert np.allclose(first_biases([""] * 3 + ["alone"]), first_biases(["alone"] + [""] * 3))


def test_toxicity_learns_and_scores_every_row(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 40) + (" you zogmar idiot " if i % 4 == 0 else " ") + prose(rng, 40)) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(9999, 1, None)], "doc_id long, quality int, toxic int")
    extra = [(1000, None), (1001, ""), (None, "you idiot"), (1002, "a" * 100_000)]
    docs = documents(spark, rows + extra)
    model = toxicity.fit(docs, labels)
    assert any(t.startswith("zogmar") for t in model.lexicon)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 404 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 400]
    assert {r["doc_id"] for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) > 0.95
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns
    assert ordered(kept.select("doc_id").collect()) == ordered([(r["doc_id"],) for r in got if not r["predicted"]])


def test_a_model_without_labels_still_scores(spark):
    docs = documents(spark)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, model).count() == len(texts())


def test_isotonic_rates_rise():
    rng = np.random.default_rng(0)
    at, rate = toxicity.isotonic(rng.standard_normal(300), rng.integers(0, 2, 300).astype(float))
    assert (np.diff(at) > 0).all() and (np.diff(rate) >= 0).all()


@pytest.mark.parametrize("run", [
    lambda d: suffix_dedup.deduplicated(d), lambda d: chosen_path.similar(d), lambda d: kdtree.shard(d, 4), lambda d: packing.pack(d),
    lambda d: pseudo_likelihood.score(d), lambda d: chunked_bpe.encode(d, vocabulary_path("word_bpe_49k.json")),
])
def test_empty_tables_give_no_rows(spark, run):
    assert run(documents(spark, [])).count() == 0


@pytest.mark.parametrize("recall", [0.9, 0.99, 0.9997])
def test_chosen_paths_reach_their_recall(recall):
    """Sketches of pairs at the threshold, by the real splits of all runs and levels."""
    paths = chosen_path.Paths(recall=recall)
    assert paths.loss(paths.runs) <= 1 - recall < paths.loss(paths.runs - 1) or paths.runs == 1
    rng = np.random.default_rng(int(recall * 1e4))
    n = 4000
    a = rng.integers(1 << 32, size=(n, chosen_path.SKETCH), dtype=np.uint64).astype(np.uint32)
    b = np.where(rng.random(a.shape) < paths.threshold, a, rng.integers(1 << 32, size=a.shape, dtype=np.uint64).astype(np.uint32))
    agreed = (a == b).sum(axis=1) >= paths.least_agreement
    met = np.zeros(n, dtype=bool)
    for r in range(paths.runs):
        here = np.arange(n)
        node = chosen_path.mixed(np.full(n, r + 1, dtype=np.uint64))
        for _ in range(chosen_path.LEVELS):
            left, right = paths.children(a[here], node), paths.children(b[here], node)
            pairs = [dict.fromkeys(zip(here[row].tolist(), child.tolist())) for row, child in (left, right)]
            shared = [p for p in pairs[0] if p in pairs[1]]
            here = np.array([i for i, _ in shared], dtype=np.int64)
            node = np.array([c for _, c in shared], dtype=np.uint64)
        met[here] = True
    found = (met & agreed).mean()
    assert found >= recall - 3 * np.sqrt(recall * (1 - recall) / n) - 1e-9
