"""The operators against brute force, on rows of every awkward kind."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import (
    archives,
    chat,
    decontaminate,
    mixing,
    ngram_join,
    quality_rules,
    quality_sampling,
    queries,
    substring,
    token_counts,
    token_files,
    words,
)
from tastegraph.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, text_key long, place int, n int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_list(text):
    return WORD.findall(text or "")


def _texts():
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(300)] + ["The", "ÉTÉ", "été", "a,", "x\x85y", "中文", "😀", "don't", "</s>"]
    prose = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    base, passage = prose(120).split(), prose(70)
    near = []
    for i in range(12):
        copy = list(base)
        for _ in range(1 + i % 3):
            copy[rng.randrange(len(copy))] = rng.choice(pool)
        near.append(" ".join(copy))
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "ONE", "two words", "Two  words\n", prose(4), prose(5)]
    texts += [" ".join(base), " ".join(base).upper(), *near, prose(60) + "\n" + passage + "\n" + prose(40), passage + " " + prose(10)]
    texts += [passage, "same " * 300, "line one\nline two\nline one\n\n\nline one", prose(40_000), "z" * 100_000, "z" * 100_000]
    texts += [" ".join(base[:60]), " ".join(base[:60]), prose(49), prose(50), "é" * 300 + "̃ j̃ J̌ <|endoftext|> x<|endoftext|>"]
    return texts


TEXTS = _texts()


@pytest.fixture(scope="module")
def rows():
    """(doc_id, text, source) with missing ids and sources, repeated rows, out of order."""
    out = [(i, t, None if i % 7 == 3 else f"s{i % 3}") for i, t in enumerate(TEXTS)]
    out += [out[9], out[9], out[2], (None, TEXTS[9], "s0"), (None, None, None), (None, "no id here at all", None)]
    random.Random(1).shuffle(out)
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 5, "k", 1, 2, 3) for i, t, s in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    kind = "doc_id long, quality int, toxic int"
    marks = [(i, int(i % 3 > 0), 0) for i in range(9, 24)]
    return spark.createDataFrame([*marks, (None, 1, 0), (25, None, None), (26, 1, 1), (9, 0, 0)], kind)


def test_words_follow_the_pattern_in_any_block_size():
    for most in (1, 7, 1 << 20):
        got = []
        for block in words.blocks(pa.array(TEXTS[:-12]), most):
            assert len(block.hashes()) == len(block.begin)
            for row in range(block.rows):
                at = slice(block.first[row], block.first[row] + block.count[row])
                got.append([block.data[a:b].tobytes().decode() for a, b in zip(block.begin[at], block.end[at])])
        assert got == [word_list(t) for t in TEXTS[:-12]]


def test_rolling_hash_depends_on_the_window_only():
    some = np.arange(1, 120, dtype=np.uint64)
    twice = words.rolling(np.concatenate([some, some[::-1], some]), 50)
    assert twice[0] == twice[238] and len(set(twice[:119].tolist())) == 119
    assert len(words.rolling(some[:49], 50)) == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (205, 200), (200, 205)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 205: 200}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def _sets(rows):
    out = []
    for _, text, _ in rows:
        w = word_list((text or "").translate(LOWER))
        out.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def _components(rows):
    sets = _sets(rows)
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                root[find(a)] = find(b)
    return sets, [find(a) for a in range(len(rows))]


def test_join_links_what_brute_force_links(docs, rows):
    sets, roots = _components(rows)
    least = {r: min((rows[a][0] for a in range(len(rows)) if roots[a] == r and rows[a][0] is not None), default=None) for r in roots}
    want = Counter((rows[a][0], len(sets[a]), least[roots[a]]) for a in range(len(rows)))
    got = ngram_join.link_documents(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == want


def test_join_with_split_groups(docs, rows, monkeypatch):
    want = Counter(map(tuple, ngram_join.link_documents(docs).select("doc_id", "component_id").collect()))
    monkeypatch.setattr(ngram_join, "SPLIT_FROM", 2)
    assert Counter(map(tuple, ngram_join.link_documents(docs).select("doc_id", "component_id").collect())) == want


@pytest.mark.parametrize("split", [10, 2])
def test_links_are_counted_as_by_brute_force(spark, docs, rows, monkeypatch, split):
    """Every link counts, also those inside a component, in one block or many."""
    monkeypatch.setattr(ngram_join, "SPLIT_FROM", split)
    monkeypatch.setattr(ngram_join, "COLUMNS", 7)
    sets = _sets(rows)
    distinct = set(sets) - {frozenset()}
    like = lambda a, b: 100 * len(a & b) >= 75 * len(a | b)
    degree = {a: sum(a != b and like(a, b) for b in distinct) for a in distinct}
    want = Counter((rows[i][0], degree.get(s, 0)) for i, s in enumerate(sets))
    assert max(degree.values()) >= 8
    assert Counter(map(tuple, ngram_join.link_documents(docs).select("doc_id", "links").collect())) == want


def test_near_copies_of_near_copies_keep_their_links(spark):
    """A chain of small steps: ends are unlike, yet one component."""
    rng = random.Random(5)
    text = [f"c{rng.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(60):
        text[(i * 3) % 200] = f"n{i}"
        rows.append((i, " ".join(text), None))
    want = Counter((rows[a][0], r) for a, r in enumerate(_components(rows)[1]))
    got = ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r["doc_id"]: r["component_id"] for r in got.collect()}
    names = {}
    for (doc, root), _ in want.items():
        names.setdefault(root, set()).add(doc)
    assert all(got[d] == min(members) for members in names.values() for d in members)


def test_one_of_each_component_stays(docs, rows):
    sets, roots = _components(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    got = [r["doc_id"] for r in kept.collect()]
    worded = {roots[a] for a in range(len(rows)) if sets[a]}
    assert len(got) == len(worded) + sum(not s for s in sets)
    for root in worded:
        ids = {rows[a][0] for a in range(len(rows)) if roots[a] == root}
        best = min((i for i in ids if i is not None), default=None)
        assert sum(g == best for g in got if g in ids) >= 1


def test_containment_matches_brute_force(spark, docs, rows):
    items = [(1, TEXTS[23]), (2, "ONE"), (3, None), (4, ""), (None, TEXTS[23] + " more words at the end here"), (5, "unseen words only in here now")]
    items += [(1, TEXTS[23]), (6, " ".join(word_list(TEXTS[9])[20:50])), (7, " ".join(word_list(TEXTS[9])[20:32] + ["x"] * 3))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_items(docs, table).collect()

    def grams(text, n):
        w = word_list((text or "").translate(LOWER))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want = set()
    for doc, text, _ in rows:
        for item, said in set(items):
            n = min(5, len(word_list(said)))
            own = grams(said, n) if n else set()
            shared = len(own & grams(text, n)) if n else 0
            if own and 100 * shared >= 75 * len(own):
                want.add((doc, item, len(own), shared))
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in got} == want and want
    assert len(got) == len({(r["doc_id"], r["text_key"], r["item_id"], r["n_item"]) for r in got})
    left = Counter(r["doc_id"] for r in decontaminate.clean(docs, table).collect())
    hit = {(d, t) for d, t, _ in rows for i in want if i[0] == d and d is not None}
    assert not {d for d, _ in hit} & set(left)
    assert decontaminate.clean(docs, table.limit(0)).count() == len(rows)


def test_windows_match_brute_force(docs, rows):
    first = {}
    for doc, text, _ in rows:
        w = word_list(text)
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, 1 << 62), (1 << 62) if doc is None else doc)
    want = Counter()
    for doc, text, _ in rows:
        w, gone = word_list(text), set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < ((1 << 62) if doc is None else doc):
                gone |= set(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want[(doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    got = substring.cut(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert Counter(map(tuple, got)) == want
    assert sum(k[2] for k in want) > 0


def test_token_counts_are_the_librarys(docs, rows):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    want = Counter((d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t, _ in rows)
    got = token_counts.count_tokens(docs, path).select("doc_id", "n_bytes", "n_tokens").collect()
    assert Counter(map(tuple, got)) == want


def test_transducers_on_odd_strings():
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    tokenizer, counter = Tokenizer.from_file(path), token_counts.Counter(path)
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "a", "'s", "'", "re", "'ll", "ing", "1", "23", "!", "é", "中", "😀", " ", ".", "<|", "|>", "<|endoftext|>", "ation", "́", "x" * 300]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    got = [int(n) for block in words.blocks(pa.array(texts), 5000) for n in counter.count(block)]
    assert got == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    # A forgotten table gives the same counts.
    counter.pieces.forget()
    assert [int(n) for block in words.blocks(pa.array(texts[:50])) for n in counter.count(block)] == got[:50]


def test_token_files_round_trip(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    token_files.write_files(docs, f"{tmp_path}/files", path)
    got = token_files.read_files(spark, f"{tmp_path}/files").orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [r[0] for r in ordered]
    want, start = Counter(), 0
    for doc, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want[(doc, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    for row in got:
        assert row["start"] == start
        start += row["n_tokens"]


def test_pairs_are_numbered_alike_for_narrow_and_wide_symbols():
    rng = np.random.default_rng(5)
    for most in (3, 1 << 16, 1 << 20):
        pair = (rng.integers(0, most, 5000) << 32) | rng.integers(0, most, 5000)
        wanted = np.unique(pair, return_inverse=True, return_counts=True)
        for found, right in zip(token_files._distinct(pair), wanted, strict=True):
            assert (found == right).all()
    assert all(len(part) == 0 for part in token_files._distinct(np.zeros(0, np.int64)))


def test_a_whole_block_expands_each_rule_once(monkeypatch):
    ids = np.tile(np.arange(40, dtype=np.uint32), 500)
    data = token_files.pack(0, 0, 0, [1], np.array([len(ids)]), ids, 50)
    record, expand, seen = token_files.Record(memoryview(data)), token_files.expand, []
    monkeypatch.setattr(token_files, "expand", lambda symbols, *rest: seen.append(len(symbols)) or expand(symbols, *rest))
    assert (record.all_ids() == ids).all()
    assert seen == [len(record.rules)]


def test_grammar_expands_and_reads_at_random():
    rng = np.random.default_rng(4)
    ids = np.concatenate([rng.integers(0, 30, 5000), np.tile([7, 7, 7, 1], 500), [65535, 0]]).astype(np.uint32)
    symbols, rules = token_files.re_pair(ids, 70000, 1000)
    assert len(symbols) < len(ids) and (token_files.expand(symbols, rules, 70000) == ids).all()
    record = token_files.Record(memoryview(token_files.pack(1, 2, 3, [4, None], np.array([10, len(ids) - 10]), ids, 70000)))
    for low, high in ((0, 1), (9, 11), (4990, 5040), (len(ids) - 1, len(ids)), (0, len(ids)), (5, 5)):
        assert (record.read_ids(low, high) == ids[low:high]).all()
    assert len(token_files.re_pair(np.zeros(0, np.uint32), 10, 5)[0]) == 0


def test_base_rules_match_brute_force(spark, docs, rows, labels):
    scored = quality_rules.score(docs, quality_rules.fit(docs, labels))
    want = Counter()
    for doc, text, _ in rows:
        w = word_list(text)
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        three = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        cover = {j for i in range(len(w) - 2) if three[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        signs = len(re.findall(r"[#*$%&|<>]", text or ""))
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        want[(doc, len(w), sum(map(len, w)), signs, len(lines) - len(set(lines)), len(cover), failed)] += 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter(map(tuple, scored.select(names).collect())) == want
    assert scored.where("base_failed AND kept").isEmpty()


def _labelled(spark, n):
    rng = random.Random(9)
    rows, marks = [], []
    for i in range(n):
        good, toxic = i % 4 > 0, i % 8 == 1
        text = [f"v{rng.randrange(400)}" for _ in range(80)]
        if not good:
            text = [w.upper() + "!!" for w in text]
        if toxic:
            text[10], text[30], text[50] = "vile", "nasty", "vile"
        rows.append((i, " ".join(text)))
        marks.append((i, int(good), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), marks


def test_classifier_on_held_out_rows(spark):
    docs, marks = _labelled(spark, 1600)
    known = spark.createDataFrame([m for m in marks if m[0] < 1000], "doc_id long, quality int, toxic int")
    scored = {r["doc_id"]: r for r in quality_rules.score(docs, quality_rules.fit(docs, known)).collect()}
    right = [scored[i]["kept"] == (q == 1 and t == 0) for i, q, t in marks if i >= 1000]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["probability"] <= 1 for r in scored.values())


def test_resampling_keeps_clean_and_drops_other(spark):
    docs, marks = _labelled(spark, 4000)
    known = spark.createDataFrame([m for m in marks if m[0] % 2], "doc_id long, quality int, toxic int")
    drawn = {r["doc_id"]: r["kept"] for r in quality_sampling.resample(docs, known).collect()}
    again = {r["doc_id"]: r["kept"] for r in quality_sampling.resample(docs, known).collect()}
    assert drawn == again
    clean = [drawn[i] for i, q, t in marks if q == 1 and t == 0]
    other = [drawn[i] for i, q, t in marks if q == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(other) <= 0.01 * len(other)


@pytest.mark.parametrize("n", [240, 1600])
def test_resampling_drops_toxic_at_any_size(spark, n):
    docs, marks = _labelled(spark, n)
    known = spark.createDataFrame([m for m in marks if m[0] % 16 < 10], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in quality_sampling.resample(docs, known).collect()}
    clean = [kept[i] for i, q, t in marks if i % 16 >= 10 and q == 1 and t == 0]
    toxic = [kept[i] for i, _, t in marks if t]
    assert sum(clean) >= 0.95 * len(clean) and sum(toxic) <= 0.05 * len(toxic)


def test_kth_largest(spark):
    values = [5, 5, 5, -3, 10**15, 0, -(10**15), 7]
    table = spark.createDataFrame([(v,) for v in values], "x long")
    for k in range(1, len(values) + 1):
        assert quality_sampling.kth_largest(table, "x", k) == sorted(values, reverse=True)[k - 1]
    assert quality_sampling.kth_largest(table, "x", 0) is None


def test_resampling_of_awkward_rows(docs, rows, labels, empty):
    assert quality_sampling.keep(docs, labels).columns == docs.columns
    assert quality_sampling.resample(docs, labels).count() == len(rows)
    assert quality_sampling.resample(docs, labels.limit(0)).where("NOT kept").isEmpty()


def test_mix_meets_its_targets(docs, rows):
    mixed = mixing.mix(docs).collect()
    assert len(mixed) == len(rows)
    assert sorted(map(tuple, mixed), key=str) == sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    size, taken, largest, target = Counter(), Counter(), Counter(), {}
    for r in mixed:
        assert r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    # Rows alike are rounded together, so a unit may be several rows.
    units = Counter()
    for r in mixed:
        units[(r["doc_id"], r["source"], r["text_key"])] += r["size"]
    for (_, source, _), n in units.items():
        largest[source] = max(largest[source], n)
    for source in size:
        assert size[source] == next(r["source_size"] for r in mixed if r["source"] == source)
        assert abs(taken[source] - target[source]) <= largest[source]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    again = mixing.apply_mix(docs)
    assert again.columns == docs.columns
    got = sum(len(word_list(r["text"])) for r in again.collect())
    assert got == sum(taken.values())


def test_many_blocks_meet_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    docs = spark.createDataFrame([(i, "w " * (i % 9 + 1), f"s{i % 2}") for i in range(400)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    for source in ("s0", "s1"):
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 9


def test_targets_share_out_what_is_above_the_bound():
    assert mixing.targets([("a", 100), ("b", 100)]) == {"a": pytest.approx(1000 / 7), "b": pytest.approx(400 / 7)}
    got = mixing.targets([("a", 10), ("b", 500), (None, 90)])
    assert got["a"] == 30 and got["b"] == pytest.approx(380) and got[None] == pytest.approx(190)
    assert mixing.targets([("a", 0)]) == {"a": 0}


def test_pivot_keeps_the_sum():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randint(1, 12)
        amounts, chances = [rng.randint(1, 50) for _ in range(n)], [rng.random() for _ in range(n)]
        out = mixing.pivot([rng.getrandbits(60) for _ in range(n)], amounts, chances)
        assert sum(a * c for a, c in zip(amounts, chances)) == pytest.approx(sum(a * c for a, c in zip(amounts, out)))
        assert sum(0 < c < 1 for c in out) <= 1


def test_pages_become_records_and_revisits(spark, tmp_path):
    pages = [(i, f"http://x/{i} y", h) for i, h in enumerate(["<a>", "<b>\r\n\r\n<c>", "<a>", "", None, "é" * 70_000, "<a>", "é" * 70_000])]
    pages += [(6, None, "<a>"), (None, "http://none/", "<a>"), (None, None, None), (1, "http://x/1 y", "<b>\r\n\r\n<c>")]
    table = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int").repartition(4)
    archives.write_warc(archives.pages_to_arc(table), f"{tmp_path}/warc")
    got = archives.read_warc(spark, f"{tmp_path}/warc").collect()
    first = {}
    for page, _, body in pages:
        if page is not None:
            first[body or ""] = min(page, first.get(body or "", page))
    want, left = Counter(), dict.fromkeys(first)
    for page, _, body in pages:
        data = (body or "").encode()
        key = (page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        original = page == first[body or ""] and left[body or ""] is None
        left[body or ""] = left[body or ""] or original or None
        want[(*key, "response", None) if original else (*key, "revisit", first[body or ""])] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want


@pytest.mark.parametrize("version", [b"1", b"2"])
def test_arc_headers_of_both_versions(version):
    records = [("http://a/b c", "20240131235958", b"HTTP/1.1 200 OK\r\nX: 1\r\n\r\nbody\nhttp://fake 0.0.0.0 1 text/html 3\n"), ("x:", "20200101000000", b"")]
    got = list(archives.parse_arc(archives.arc_file("n.arc", version, records)))
    assert [(r["url"], r["date"], r["document"]) for r in got] == records
    assert got[0]["at"] < got[1]["at"] and len(got[0]) == (8 if version == b"1" else 13)
    with pytest.raises(ValueError):
        list(archives.parse_arc(archives.arc_file("n.arc", version, records)[:-30]))


def test_small_payloads_are_not_revisited(spark, tmp_path):
    table = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    archives.write_warc(archives.pages_to_arc(table), f"{tmp_path}/w", least_bytes=3)
    got = {r["page_id"]: r["record_type"] for r in archives.read_warc(spark, f"{tmp_path}/w").collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_best_branches_of_reply_trees(spark):
    kind = "tree string, node long, parent long, score double, role string, text string"
    rows = [("t", 1, None, 1.0, "user", "q"), ("t", 2, 1, 5.0, "assistant", "a<|end|>\n"), ("t", 3, 1, 2.0, "assistant", "b"), ("t", 4, 3, 2.0, "user", None)]
    rows += [("t", 5, 4, 1.5, "assistant", "&lt;[INST]"), ("u", 1, 99, None, None, "orphan"), ("c", 1, 2, 1.0, "user", "x"), ("c", 2, 1, 1.0, "user", "y")]
    rows += [("l", i, i - 1 if i else None, 0.0, "assistant" if i % 2 else "user", f"m{i}") for i in range(100)]
    table = spark.createDataFrame(rows, kind)
    best = chat.best_paths(table, per_tree=2).orderBy("tree", "rank", "place").collect()
    by = {}
    for r in best:
        by.setdefault((r["tree"], r["rank"]), []).append(r["node"])
    assert by == {("t", 1): [1, 3, 4, 5], ("t", 2): [1, 2], ("u", 1): [1], ("l", 1): list(range(100))}
    made = {(r["tree"], r["rank"]): r for r in chat.format_paths(table, 2).collect()}
    assert chat.parse_turns(made[("t", 2)]["formatted"]) == [("user", "q"), ("assistant", "a<|end|>\n")]
    row = made[("t", 1)]
    assert [chat.unescape(row["formatted"][a:b]) for a, b in zip(row["starts"], row["ends"])] == ["b", "&lt;[INST]"]
    assert "[INST]" not in row["formatted"]


def test_plain_conversations_with_missing_values(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "x"), (None, 3, "assistant", "</s>"), (None, 1, "a\nb", "&amp;")]
    replies = chat.turns_to_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = {r["tree"]: chat.parse_turns(r["formatted"]) for r in chat.format_paths(replies).collect()}
    assert made == {"1": [("", "x"), ("user", ""), ("user", "")], "": [("a\nb", "&amp;"), ("assistant", "</s>")]}


def test_empty_tables(spark, empty, labels, tmp_path):
    items = spark.createDataFrame([(1, "some words of an item here")], "item_id long, text string")
    assert ngram_join.link_documents(empty).isEmpty() and ngram_join.keep_one(empty).isEmpty()
    assert decontaminate.find_items(empty, items).isEmpty() and substring.cut(empty).isEmpty()
    assert quality_sampling.keep(empty, labels).isEmpty() and mixing.apply_mix(empty).isEmpty()
    assert quality_rules.score(empty, quality_rules.fit(empty, labels.limit(0))).isEmpty()
    assert token_counts.count_tokens(empty, queries.vocabulary("byte_bpe_50k.json")).isEmpty()
    token_files.write_files(empty, f"{tmp_path}/t", queries.vocabulary("word_bpe_49k.json"))
    assert token_files.read_files(spark, f"{tmp_path}/t").isEmpty()
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives.write_warc(archives.pages_to_arc(pages), f"{tmp_path}/w")
    assert archives.read_warc(spark, f"{tmp_path}/w").isEmpty()
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_paths(chat.turns_to_replies(turns))).isEmpty()


def test_floor_counts_every_labelled_document(spark):
    """More labels than any earlier cap, against the places between all weights by brute force."""
    n = 50_000
    ids = np.arange(n)
    wanted = (ids * 7919) % 10 < 6
    weight = np.round(((ids * 104729) % 1000) / 100 + np.where(wanted, 3, 0), 2)
    table = pa.table({"id": ids, "log_weight": weight - 0.5 * wanted, "unlabelled": weight})
    labels = pa.table({"doc_id": ids, "quality": wanted.astype(np.int32), "toxic": np.zeros(n, np.int32)})
    chosen = quality_sampling.choose_floor(spark.createDataFrame(table), spark.createDataFrame(labels))
    good, other = np.sort(weight[wanted]), np.sort(weight[~wanted])
    both = np.unique(weight)
    places = np.concatenate([both[:1], (both[1:] + both[:-1]) / 2])
    right = np.searchsorted(other, places) - np.searchsorted(good, places)
    best = np.flatnonzero(right == right.max())
    assert chosen == pytest.approx(places[best[len(best) // 2]], abs=1e-9)
    nothing = spark.createDataFrame(labels).withColumn("quality", F.lit(0))
    assert quality_sampling.choose_floor(spark.createDataFrame(table), nothing) == -quality_sampling.FLOOR


def test_ngram_join_keeps_only_entries_that_can_first_meet(spark, monkeypatch):
    rng = random.Random(11)
    pool = [f"v{i}" for i in range(60)]
    passage = " ".join(rng.choice(pool) for _ in range(8))
    prose = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    # One passage in texts that cannot link: sizes too far apart, or too little after it.
    apart = [f"{passage} {prose(n)}" for n in (20, 60, 140, 300)]
    base = prose(80).split()
    near = [" ".join(base), " ".join([*base[:-1], "last"]), " ".join(["first", *base[1:]])]
    rows = [(i, t) for i, t in enumerate(apart + near)]
    kept = {}

    def recorded(frame, name):
        kept[name] = real(frame, name)
        return kept[name]

    real = ngram_join.stage
    monkeypatch.setattr(ngram_join, "stage", recorded)
    monkeypatch.setattr(ngram_join, "free", lambda *tables: None)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in ngram_join.link_documents(docs).collect()}
    assert {i: (r["component_id"], r["links"]) for i, r in got.items()} == {
        **{i: (i, 0) for i in range(4)}, 4: (4, 2), 5: (4, 2), 6: (4, 2)
    }
    assert {r["set_id"] for r in kept["shared"].collect()} == {got[i]["set_id"] for i in (4, 5, 6)}


def test_ngram_join_builds_few_rows_at_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500))], ["id"])
    parts = list(ngram_join._pieces([batch, batch.slice(0, 0), batch]))
    assert max(p.num_rows for p in parts) <= ngram_join.ROWS < 2500
    assert [x for p in parts for x in p.column(0).to_pylist()] == [*range(2500), *range(2500)]
