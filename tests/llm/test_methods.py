"""The operators' array methods against brute force; no Spark."""

import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridmend.llm import hamming_search, ngram_join, packing, repair, toxicity, vector_dedup, words

os.environ["TOKENIZERS_PARALLELISM"] = "false"
public_tokenizers = pytest.importorskip("public_tokenizers")


def odd_texts(n=300, seed=1):
    rnd = random.Random(seed)
    letters = " \n\t ab,.'sE1é世 　́ß<|endoftext|>\x1c\x85​Σσİ"
    made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    return [*made, None, "", " ", "  a", " a ", "it's 'll x", "The end.\nOf a line, and", "word " * 3000]


@pytest.mark.parametrize("name,end,spaces", [("byte_bpe_50k.json", 2, True), ("word_bpe_49k.json", 1, False)])
def test_pieces_give_the_ids_of_whole_texts(name, end, spaces):
    from tokenizers import Tokenizer

    definition = words.definition(public_tokenizers.path(name))
    whole = Tokenizer.from_str(definition)
    whole.encode_special_tokens = True
    texts = odd_texts()
    ids, at = words.Encoder(definition, spaces).ids(pa.array(texts), end)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids + [end]


@pytest.mark.parametrize("name,end,spaces", [("byte_bpe_50k.json", 2, True), ("word_bpe_49k.json", 1, False)])
def test_strings_of_special_tokens_give_the_ids_of_the_plain_library(name, end, spaces):
    from tokenizers import Tokenizer

    definition = words.definition(public_tokenizers.path(name))
    plain = Tokenizer.from_str(definition)
    texts = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b  c", "x <|startoftext|> y", "<|ENDOFTEXT|> a b", "<|endof text|> a", "a b c", "", "a <|endoftext|><|startoftext|>"]
    ids, at = words.Encoder(definition, spaces).ids(pa.array(texts), end)
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids + [end]


@pytest.mark.parametrize("name,end,spaces", [("byte_bpe_50k.json", 2, True), ("word_bpe_49k.json", 1, False)])
def test_words_with_marks_and_line_breaks_are_asked_for_in_bulk_and_once(name, end, spaces):
    from tokenizers import Tokenizer

    definition = words.definition(public_tokenizers.path(name))
    whole, encoder, single, asked = Tokenizer.from_str(definition), words.Encoder(definition, spaces), [], []
    piece, ask = encoder._piece, encoder._asked
    encoder._piece = lambda p: (single.append(p), piece(p))[1]
    encoder._asked = lambda w: (asked.append(w), ask(w))[1]
    texts = ["A loud*** thing, (not $$$ end.\nOf it--\nÜber] a_b x!?", "So loud.\nOf thing*** it\nend;\nloud", "It's 4all a  b\n\nc"]
    for _ in range(2):
        asked.clear()
        ids, at = encoder.ids(pa.array(texts), end)
        for i, text in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids + [end]
    assert not {" loud***", " end.\nOf", " it--\nÜber]", " x!?"} & set(single)
    assert not asked  # the second time


def test_rows_of_the_format_are_read_as_arrays():
    codes, counts, ids, at = np.array([0, 1, 0]), np.array([2, 1]), np.array([5, 6, 5, 7]), np.array([0, 2, 4])
    row = repair.compress(codes, counts, ids, at, 2) | {"part": 0, "shard": 1, "at": 9, "doc_ids": [None, 4]}
    shard = repair.shard_of(pa.RecordBatch.from_pylist([row], schema=repair.ARROW), 0)
    assert all(isinstance(shard[n], np.ndarray) for n in ("n_tokens", "symbol_ends", "terminals", "left", "right", "lengths"))
    assert shard["doc_ids"].to_pylist() == [None, 4] and (shard["part"], shard["at"]) == (0, 9)
    found, ends = repair.decode(shard)
    assert found.tolist() == [5, 6, 5, 7, 2, 5, 6, 2] and ends.tolist() == [5, 8]


def frequent_pairs(shard):
    """Pairs of symbols that occur ``MIN_COUNT`` times in a shard without overlap."""
    symbols = np.frombuffer(shard["symbols"], f"<u{shard['width']}").tolist()
    counts, start = Counter(), 0
    for end in shard["symbol_ends"]:
        i, last = start, None
        while i + 1 < end:
            pair = (symbols[i], symbols[i + 1])
            if pair[0] == pair[1] and last == (pair, i - 1):  # overlaps the one before
                last = None
            else:
                counts[pair] += 1
                last = (pair, i)
            i += 1
        start = end
    return [p for p, n in counts.items() if n >= repair.MIN_COUNT]


def test_replacing_goes_on_until_no_pair_is_frequent():
    """Repeats of all kinds, sequences of one symbol and none, with and without weights; every rule is used."""
    rnd = random.Random(6)
    for seed in range(30):
        parts = [[rnd.randrange(rnd.choice([1, 3, 20, 300])) for _ in range(rnd.choice([0, 1, 2, 5, 50, 2000]))] for _ in range(rnd.choice([1, 4, 40]))]
        flat, ends = np.array(sum(parts, []), np.int64), np.cumsum([len(p) for p in parts])
        weights = np.array([rnd.choice([1, 1, 5]) for _ in parts]) if seed % 3 == 0 else None
        symbols, new_ends, lefts, rights = repair.replace_pairs(flat, ends, weights, 300)
        left, right = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (lefts, rights))
        lengths = np.ones(300 + len(left), np.int64)
        for i, (a, b) in enumerate(zip(left, right)):
            lengths[300 + i] = lengths[a] + lengths[b]
        full, at = repair.expansions(np.arange(300), left, right, lengths)
        back = [full[at[s] : at[s + 1]].tolist() for s in symbols]
        starts = np.append(0, new_ends)
        assert [sum(back[a:b], []) for a, b in zip(starts, starts[1:])] == parts
        if weights is None:
            assert not frequent_pairs({"symbols": symbols.astype("<u4").tobytes(), "width": 4, "symbol_ends": new_ends.tolist()})
            used = Counter(symbols.tolist()) + Counter(left.tolist()) + Counter(right.tolist())
            assert all(used[300 + i] > 0 for i in range(len(left)))


def test_part_of_one_long_symbol_opens_the_rules_on_its_way_only():
    ids = np.zeros(1 << 20, np.uint32)
    shard = repair.compress(np.zeros(1, np.int64), np.array([1]), ids, np.array([0, len(ids)]), 2)
    part, ends = repair.decode(shard, 0, 700_000, 700_010)
    assert part.tolist() == [0] * 10 and ends.tolist() == [10] and len(shard["symbols"]) // shard["width"] < 40
    assert repair.decode(shard, 0, (1 << 20) - 1)[0].tolist() == [0, 2] and repair.decode(shard, 0, 5, 5)[0].tolist() == []


def test_grammars_round_trip_and_give_any_part():
    encoder = words.Encoder(words.definition(public_tokenizers.path("byte_bpe_50k.json")), True)
    texts = pa.array([*odd_texts(50), "the same words again and again " * 400, "aaaa" * 500])
    encoded = encoder.encode(texts)
    want, at = words.joined(*encoded, 2)
    shard = repair.compress(*encoded, 2)
    ids, ends = repair.decode(shard)
    assert np.array_equal(ids, want) and np.array_equal(ends, at[1:])
    assert len(shard["left"]) and len(shard["symbols"]) // shard["width"] < len(want)
    assert not frequent_pairs(shard)
    for document in (0, 55, len(texts) - 2):
        own = want[at[document] : at[document + 1]]
        for a, b in ((0, 1), (1, 7), (0, None), (3, 10_000)):
            assert repair.decode(shard, document, a, b)[0].tolist() == own[a:b].tolist()


@pytest.mark.parametrize("n", [0, 1, 9, 400, 3000])
def test_packing_plans_place_every_piece_once(n):
    rng = np.random.default_rng(n)
    lengths = np.concatenate([rng.integers(1, 4097, n // 2), np.minimum(4096, rng.lognormal(6, 1.3, n - n // 2).astype(int) + 1)])
    histogram = {int(k): int(v) for k, v in Counter(lengths.tolist()).items()}
    plan = packing.plan(histogram)
    placed, ranks = {}, {}
    for s, first, count, sequence, offset in plan.rows:
        ranks.setdefault(s, []).extend(range(first, first + count))
        for k in range(count):
            placed.setdefault(sequence + k, []).append((offset, s))
    assert all(sorted(ranks[s]) == list(range(c)) for s, c in histogram.items())
    for parts in placed.values():
        parts.sort()
        assert all(a + s == b for (a, s), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0 and sum(parts[-1]) <= 4096
    assert len(placed) == plan.sequences <= 1.03 * -(-int(lengths.sum()) // 4096) + 2
    plain = packing.Plan(4096)
    for length in sorted(histogram, reverse=True):
        plain.best_fit(length, 0, histogram[length])
    assert plan.sequences <= min(plain.sequences, packing.linear_grouping(histogram).sequences)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_slice_and_join(percent):
    rnd = random.Random(percent)
    sets = []
    for _ in range(120):
        base = [rnd.getrandbits(60) for _ in range(rnd.choice([1, 2, 5, 9, 10, 15, 30, 100, 300]))]
        for _ in range(5):
            some = {x for x in base if rnd.random() > rnd.choice([0, 0.03, 0.08])} | {rnd.getrandbits(60) for _ in range(rnd.choice([0, 0, 1, 3]))}
            sets.append(some or set(base))
    grams, sizes = np.concatenate([np.array(sorted(s), np.uint64) for s in sets]), np.array([len(s) for s in sets])
    common = np.sort(grams[:: 7])
    keys = [set() for _ in sets]
    for i, k in zip(*(a.tolist() for a in ngram_join.slice_keys(grams, sizes, percent, np.unique(common)))):
        keys[i].add(k)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                assert keys[a] & keys[b]
                parent[max(root(a), root(b))] = min(root(a), root(b))
    label = ngram_join.linked(grams, sizes, percent).tolist()
    roots = [root(i) for i in range(len(sets))]
    assert len(set(zip(roots, label))) == len(set(roots)) == len(set(label))


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_shingle_of_their_prefixes(percent):
    """In the order of rarity, with many common shingles, few and none."""
    rnd = random.Random(percent)
    for share in (0, 0.3, 0.9):
        bases = [[rnd.getrandbits(60) for _ in range(rnd.choice([1, 2, 5, 30, 100]))] for _ in range(40)]
        sets = [{x for x in b if rnd.random() > 0.05} | {rnd.getrandbits(60) for _ in range(rnd.choice([0, 1, 3]))} or set(b) for b in bases for _ in range(4)]
        grams, sizes = np.concatenate([np.array(sorted(s), np.uint64) for s in sets]), np.array([len(s) for s in sets])
        common = np.array(sorted({x for x in set().union(*sets) if rnd.random() < share}), np.uint64)
        found = list(zip(*(a.tolist() for a in ngram_join.prefix_rows(grams, sizes, percent, common))))
        times, prefix = Counter(g for _, g, _ in found), []
        for i in range(len(sets)):
            mine = sorted(((times[g], g, skip) for k, g, skip in found if k == i), reverse=True)
            prefix.append({g for at, (n, g, skip) in enumerate(x for x in mine if x[0] > 1) if at >= skip})
        for a in range(len(sets)):
            for b in range(a):
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    assert prefix[a] & prefix[b]


def test_substring_tables_find_every_code_in_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (2000, 8)).astype(np.uint8)
    tables = hamming_search.Tables(codes)
    for radius in (0, 7, 20, 27):
        want = np.flatnonzero(hamming_search.distances(codes, codes[5]) <= radius)
        assert np.array_equal(tables.within(codes[5], radius), want)


def test_cells_come_in_the_order_of_the_whole_grid():
    rng = np.random.default_rng(3)
    grid = vector_dedup.Grid(rng.normal(size=(9, 4)), rng.normal(size=(9, 4)), 12)
    x = rng.normal(size=(50, 8))
    far = vector_dedup.nearest(x[:, :4], grid.first)[:, :, None] + vector_dedup.nearest(x[:, 4:], grid.second)[:, None, :]
    assert np.array_equal(grid.cells(x), far.reshape(50, -1).argsort(axis=1, kind="stable")[:, :12])


def test_misspelt_words_score_like_the_words_they_resemble():
    rnd = random.Random(5)
    plain = ["".join(rnd.choice("tnaeiors") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    bad = ["gruffelwort", "blixmuk", "zakkenpox"]
    texts, labels = [], []
    for i in range(300):
        body = [rnd.choice(plain) for _ in range(40)] + ([rnd.choice(bad) for _ in range(3)] if i % 3 == 0 else [])
        rnd.shuffle(body)
        texts.append(" ".join(body))
        labels.append(int(i % 3 == 0))
    model = toxicity.calibrated(pa.array(texts), np.array(labels), 1 / 3)
    scores = model.score(pa.array(texts))
    assert ((scores >= 0.5) == np.array(labels)).mean() > 0.97
    unseen, usual = model.word_scores(["gruffelwrt", "bliixmuk"]), model.word_scores(plain)
    assert unseen.min() > np.percentile(usual, 99)
    assert model.score(pa.array(["", None, " .,"])).tolist() == [0, 0, 0]


def test_visits_grow_until_the_recall_is_met():
    """Vectors far apart that link at a low cosine need more cells than are looked at first."""
    rng = np.random.default_rng(2)
    grid = vector_dedup.fit(rng.normal(size=(3000, 32)), 32 * 32 * vector_dedup.PER_CELL, 0.3)
    assert grid.visits > 64
    x = vector_dedup.unit(rng.normal(size=(1000, 32)))
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    y = 0.3 * x + np.sqrt(1 - 0.3**2) * vector_dedup.unit(aside)
    mine, theirs = grid.cells(x), grid.cells(y)
    met = (mine == theirs[:, :1]).any(1) | (theirs == mine[:, :1]).any(1)
    assert met.mean() > vector_dedup.RECALL - 0.03
