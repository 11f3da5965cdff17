"""Each operator against brute force on a small table with nulls, empty and long texts, ties, repeated rows and
extra columns of clashing names; and on an empty table."""

import numpy as np
import public_tokenizers
import pytest
from corpus_fixtures import (EXTRA, SCHEMA, alnum_words, brute_components, brute_decontamination, brute_substrings, crc, documents,
                      held_out, ordered, sha, space_words, stored, table)
from pyspark.sql import functions as F

from docsift.llm import (bwt, decontamination, exact_dedup, exchange, jaccard_join, language_id, licenses, packing,
                         substring_dedup, suffix_dedup, token_counts, token_files, tokens)

ROWS = documents()
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    return stored(spark, ROWS, tmp_path_factory.mktemp("docs"))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return stored(spark, [], tmp_path_factory.mktemp("none"), 1)


def collected(df, *columns):
    return ordered(df.select(*columns).collect())


# ---- 1, 4: substrings ------------------------------------------------------------------------------------

def test_suffix_dedup(docs, empty, monkeypatch):
    monkeypatch.setattr(exchange, "CHUNK_ROWS", 8)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "AT_ONCE", 50)
    expected = brute_substrings(lambda t: list((t or "").encode()), ROWS, 50, bytes, spans=True)
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    result = suffix_dedup.suffix_dedup(docs)
    assert collected(result, *columns) == expected
    assert sum(r[2] for r in expected) > 1000
    for r in result.filter("kept IS NOT NULL").collect():
        assert len(r.kept) == r.n_bytes - r.n_removed and sha(bytes(r.kept)) == r.kept_sha256
    assert suffix_dedup.suffix_dedup(empty).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_bwt_equals_sorted_suffixes(seed, tmp_path):
    rng = np.random.default_rng(seed)
    n, letters = int(rng.integers(1, 40)), 2 + seed % 3
    lengths = rng.integers(1, 30, n)
    symbols = np.zeros((n, 30), np.uint8)
    for i in range(n):
        symbols[i, :lengths[i]] = rng.integers(97, 97 + letters, lengths[i])
    collection = bwt.Collection(symbols, lengths, str(tmp_path))
    collection.build()
    suffixes = sorted(bytes(symbols[j, lengths[j] - r:lengths[j]]) for j in range(n) for r in range(lengths[j] + 1))
    common = [0] + [next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
                    for a, b in zip(suffixes, suffixes[1:])]
    assert collection.read()[1].tolist() == common
    string, start, number = collection.classes(4)
    by = {}
    for s, a, k in zip(string.tolist(), start.tolist(), number.tolist()):
        by.setdefault(k, set()).add(bytes(symbols[s, a:a + 4]))
    assert all(len(x) == 1 for x in by.values()) and len(set.union(set(), *by.values())) == len(by)
    assert len(string) == sum(max(0, x - 3) for x in lengths)


def test_substring_dedup(docs, empty, monkeypatch):
    monkeypatch.setattr(exchange, "CHUNK_ROWS", 8)
    monkeypatch.setattr(exchange, "PART_BYTES", 5000)
    expected = brute_substrings(space_words, ROWS, 13, " ".join)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert collected(substring_dedup.substring_dedup(docs), *columns) == expected
    assert sum(r[2] for r in expected) > 300
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_changed_documents_are_noticed():
    import pyarrow as pa
    replies = pa.table({"part": pa.array([0], pa.int32()), "block": pa.array([b"\x00\x00"], pa.binary())})
    with pytest.raises(RuntimeError):
        exchange.answered(np.arange(3, dtype=np.uint64), replies, 1)


# ---- 2, 3: copies ----------------------------------------------------------------------------------------

def normal(text):
    return "".join(space_words(text))


def test_exact_dedup(docs, empty):
    got = exact_dedup.exact_dedup(docs).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(sha(normal(t)), []).append((-len(t or ""), i is None, i or 0, i))
    best = {k: min(g)[3] for k, g in groups.items()}
    assert ordered((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == ordered(
        (i, best[sha(normal(t))], len(groups[sha(normal(t))]), sha(normal(t))) for i, t in ROWS)
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    assert exact_dedup.exact_dedup(empty).count() == 0
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert ordered((r.doc_id, sha(normal(r.text))) for r in left.collect()) == ordered((v, k) for k, v in best.items())


def test_rows_keep_their_numbers_when_files_split_otherwise(spark, tmp_path, monkeypatch):
    """The splits change between the step that decides and the reading that drops, as with a lost executor."""
    docs = stored(spark, ROWS, tmp_path / "a b%c", 5)
    rule, items = jaccard_join.Rule(), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    before = docs.select("text").rdd.getNumPartitions()
    for drop in (exact_dedup.drop_copies, lambda d: jaccard_join.one_of_each(d, rule),
                 lambda d: decontamination.clean_documents(d, items),
                 lambda d: exact_dedup.drop_copies(d.withColumn("text", F.upper("text")))):     # not the files as they are
        expected = ordered(drop(docs).collect())
        left = drop(docs)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        spark.conf.set("spark.sql.files.minPartitionNum", 1)
        try:
            assert docs.select("text").rdd.getNumPartitions() < before
            assert ordered(left.collect()) == expected
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
            spark.conf.unset("spark.sql.files.minPartitionNum")


def test_bloom_passes_every_repeat(spark):
    rows = spark.range(3000).selectExpr("unhex(sha2(cast(least(id, 2500) as string), 256)) sha")
    out = exact_dedup.possibly_repeated(rows, "sha", 3000)
    repeated = rows.groupBy("sha").count().filter("count > 1").select("sha")
    assert out.join(repeated, "sha").filter("NOT maybe").count() == 0
    assert out.filter("maybe").count() < 700


@pytest.mark.parametrize("rule", [jaccard_join.Rule(4, 85, 100), jaccard_join.Rule(5, 4, 5), jaccard_join.Rule(2, 6, 10)])
def test_jaccard_join(spark, docs, empty, rule, monkeypatch):
    monkeypatch.setattr(exchange, "CHUNK_ROWS", 8)
    monkeypatch.setattr(exchange, "PART_BYTES", 5000)
    monkeypatch.setattr(jaccard_join, "RARE", 2)
    labels, sets = brute_components(ROWS, *rule)
    least = {}
    for label, (i, _) in zip(labels, ROWS):
        if i is not None:
            least[label] = min(least.get(label, i), i)
    expected = ordered((i, len(s), least.get(label)) for (i, _), s, label in zip(ROWS, sets, labels))
    result = jaccard_join.jaccard_components(docs, rule)
    assert collected(result, "doc_id", "n_shingles", "component_id") == expected
    assert jaccard_join.jaccard_components(empty, rule).count() == 0
    left = jaccard_join.one_of_each(docs, rule)
    assert left.columns == docs.columns and left.count() == len(set(labels))


@pytest.mark.parametrize("seed", range(6))
def test_signatures_meet_for_every_pair_that_links(seed):
    """The prefix argument itself, on random sets around the threshold, with few and many frequent tokens."""
    rng = np.random.default_rng(seed)
    rule = [jaccard_join.Rule(4, 85, 100), jaccard_join.Rule(5, 4, 5)][seed % 2]
    universe = np.unique(rng.integers(1, 1 << 62, 4000).astype(np.uint64))
    classes = rng.integers(1, 10 if seed < 3 else 6, len(universe)).astype(np.uint8)
    found = 0
    for _ in range(150):
        size = int(rng.integers(2, 300))
        a = rng.choice(len(universe), size, replace=False)
        keep = a[rng.random(size) > rng.choice([0.02, 0.06, 0.1])]
        b = np.unique(np.concatenate([keep, rng.choice(len(universe), int(rng.integers(0, 1 + size // 10)))]))
        if len(b) == 0 or not rule.holds(len(np.intersect1d(a, b)), len(a), len(b)):
            continue
        found += 1
        marks = []
        for s in (a, b):
            s = s[np.lexsort((universe[s], classes[s]))]
            marks.append(jaccard_join.signatures(rule, len(s), universe[s], classes[s]))
        assert len(np.intersect1d(*marks))
    assert found > 20


# ---- 5, 6: scans -----------------------------------------------------------------------------------------

ITEMS = [(1, ROWS[3][1]), (2, "A b"), (3, None), (4, ""), (5, "Ti-ra lo ne"), (1, ROWS[3][1]), (6, ROWS[9][1])]


def test_decontamination(spark, docs, empty, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    expected = brute_decontamination(ROWS, ITEMS)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert collected(decontamination.report(docs, items), *columns) == expected
    assert any(r[5] for r in expected) and not all(r[5] for r in expected)
    one = decontamination.hits(docs, items).select("doc_id", "n_words", "spans", "items")
    many = decontamination.hits(docs, items, block_bytes=100).select("doc_id", "n_words", "spans", "items")
    assert ordered(one.collect()) == ordered(many.collect())
    clean = decontamination.clean_documents(docs, items)
    kept = ordered(clean.collect())
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r[5] for r in expected)
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)
    assert ordered(decontamination.clean_documents(docs, items).collect()) == kept
    none = items.filter("false")
    assert decontamination.report(docs, none).filter("n_hit > 0").count() == 0
    assert decontamination.report(empty, items).count() == 0


def test_items_without_an_id_are_hits(spark, docs):
    columns = ["doc_id", "n_words", "n_hit", "contaminated"]
    named = spark.createDataFrame([(1, ROWS[3][1]), (2, ROWS[9][1])], "item_id bigint, text string")
    items = spark.createDataFrame([(1, ROWS[3][1]), (None, ROWS[9][1])], "item_id bigint, text string")
    expected = collected(decontamination.report(docs, named), *columns)
    alone = collected(decontamination.report(docs, named.filter("item_id = 1")), *columns)
    ids = collected(decontamination.report(docs, named.filter("item_id = 1")), "doc_id", "n_items", "items_sha256")
    assert expected != alone
    for size in (decontamination.BLOCK_BYTES, 100):
        hits = decontamination.hits(docs, items, block_bytes=size).mapInArrow(decontamination._digest, decontamination._DIGEST)
        assert collected(hits, *columns) == expected
        assert collected(hits, "doc_id", "n_items", "items_sha256") == ids
    assert decontamination.clean_documents(docs, items).count() == sum(not r[3] for r in expected)


LICENSED = [(1, "Under the MIT License, and the mit  license."), (2, "GNU General Publik License v3"),
            (3, "gnu general public license. Apache-License; CC BY 4.0"), (4, "permit licenses"), (5, None), (6, ""),
            (7, "the Apache Licence"), (8, "cc by cc by"), (None, "mit license"), (9, "x " * 3000 + "mit\nlicense")]


def test_licenses(spark, empty):
    got = {r.doc_id: r for r in licenses.report(table(spark, LICENSED)).collect()}
    for i, t in LICENSED:
        words, starts, labels = alnum_words(t), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            for a in range(len(words)):
                if words[a:a + len(p)] == p:
                    starts.append(a)
                    labels.add(label)
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert labels <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
    assert got[2].labels == "gpl" and got[7].labels == "apache" and got[4].labels == ""
    fuzzy = {(r.doc_id, r.label, r.edits) for r in licenses.spans(table(spark, LICENSED)).collect() if r.kind == "fuzzy"}
    assert {(2, "gpl", 1), (7, "apache", 1)} <= fuzzy
    assert licenses.report(empty).count() == 0


def test_only_runs_that_may_share_a_window_are_ordered():
    """Two runs of an anchor agree on ``before`` and ``after`` bytes around it: an equal window needs 30 in all."""
    rng = np.random.default_rng(3)
    flank = suffix_dedup.WIDTH - suffix_dedup.GRAM

    def agree(before: int, after: int) -> bool:
        strings = np.zeros((2, suffix_dedup._LONGEST + 1), np.uint8)
        strings[:, 0] = suffix_dedup._LONGEST
        strings[0, 1:] = rng.integers(1, 100, suffix_dedup._LONGEST)
        strings[1, 1:] = strings[0, 1:] + 100
        shared = slice(1 + flank - before, 1 + flank + suffix_dedup.GRAM + after)
        strings[1, shared] = strings[0, shared]
        out = suffix_dedup._agreeing(strings, np.array([7, 7], np.uint32), np.array([flank, flank], np.uint8))
        assert out[0] == out[1]
        return bool(out[0])

    assert all(agree(d, flank - d) for d in range(flank + 1))
    assert not any(agree(d, 15) for d in range(10)) and not any(agree(15, d) for d in range(10))


# ---- 7, 9, 10: tokens ------------------------------------------------------------------------------------

TRICKY = [t or "" for _, t in ROWS] + [
    "a  b", " a", "a ", "a\n\nb", "a \n b", "it's we'll I'D 'S", "x<|endoftext|>y <|endoftext|> z", "...,,", "a.b,c. d",
    "12 345.6,7", "日本語 テキスト。", "é e ́", " x y", "A\x00B", "İstanbul ΑΣ ΣΑΣ", "don't.stop,", "_,_ ._", "w.\nv"]


def test_ids_are_the_librarys():
    spaces = [f"a{chr(c)}b {chr(c)} c" for c in range(0x3001) if chr(c).isspace()]
    for kind, path in ((tokens.ByteLevel, BYTE), (tokens.WordLevel, WORD)):
        encoder = kind(path)
        for texts in (TRICKY, spaces, TRICKY):
            for text, values in zip(texts, encoder.values(texts)):
                assert b"".join(values) == tokens.packed(encoder.tokenizer.encode(text, add_special_tokens=False).ids), text


def test_ids_of_slices_are_the_librarys():
    spaces = [f"a{chr(c)}b {chr(c)} c" for c in range(0x3001) if chr(c).isspace()]
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    words = [" ".join("".join(rng.choice(letters[:52] if i % 2 else letters, rng.integers(1, 15))) for _ in range(40)) for i in range(200)]
    for kind, path in ((tokens.ByteLevel, BYTE), (tokens.WordLevel, WORD)):
        encoder = kind(path)
        assert encoder.ranks
        for texts in (TRICKY, spaces, TRICKY[::-1], words, [""], []):
            ids, ends = encoder.ids_and_end(texts, 1)
            assert len(ends) == len(texts) and len(ids) == (ends[-1] if texts else 0)
            for text, got in zip(texts, np.split(ids, ends[:-1])):
                assert got.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1], text


def test_words_need_no_table():
    """Words that were never met cost no entry of the bounded table, so none is pushed out and merged again."""
    for kind, path in ((tokens.ByteLevel, BYTE), (tokens.WordLevel, WORD)):
        encoder = kind(path)
        before = len(encoder.units)
        encoder.ids(["one two Drei cinq été Straße"])
        assert len(encoder.units) == before
        assert kind(path).ids(["a1 b"])[0].tolist() == encoder.tokenizer.encode("a1 b", add_special_tokens=False).ids


def test_white_space_beside_newlines():
    """Texts whose words are one more than their spaces and newlines, though other white space stands in them."""
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    beside = ["a\n\u00a0\u00a0b", "x\n\u00a0\u00a0b y", "x\u00a0\u00a0\nb y z"]
    beside += [t for c in spaces for t in (f"a\n{c}b", f"a\n{c}{c}b, c d", f"a{c}\nb", f"a {c}b", f"a{c}{c} b", f"a\nb{c}", f"{c}a b")]
    library = tokens.load(BYTE)
    ids = [library.encode(t, add_special_tokens=False).ids for t in beside]
    for texts, expected in ([beside, ids], [beside[:1], ids[:1]], [beside[1:2], ids[1:2]], [beside[2:3], ids[2:3]]):
        got = tokens.ByteLevel(BYTE).values(texts)
        assert [b"".join(v) for v in got] == [tokens.packed(i) for i in expected]
        counts = tokens.ByteLevel(BYTE, len).values(texts)
        assert [sum(v) for v in counts] == [len(i) for i in expected]


def test_library_knows_no_other_white_space():
    splits = tokens.load(BYTE).pre_tokenizer.pre_tokenize_str
    for c in map(chr, [*range(1, 0xd800), *range(0xe000, 0x11000)]):
        if not c.isspace():
            assert any(len(splits(f"{x}{c}{x}")) == 1 for x in "a1!"), hex(ord(c))


def test_units_and_ends_must_agree():
    encoder = tokens.ByteLevel(BYTE)
    with pytest.raises(RuntimeError):
        list(encoder.merged(["x", "\u00a0\u00a0b", " y"]))


def test_unit_table_may_overflow(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_UNITS", 20)
    encoder = tokens.ByteLevel(BYTE)
    for text in TRICKY:
        assert b"".join(encoder.values([text])[0]) == tokens.packed(encoder.tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_counts(spark, docs, empty):
    library = tokens.load(BYTE)
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in ROWS]
    expected = ordered((i, len((t or "").encode()), k, k > 1024) for (i, t), k in zip(ROWS, n))
    assert collected(token_counts.token_counts(docs, BYTE), "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert any(r[3] for r in expected)
    assert token_counts.token_counts(empty, BYTE).count() == 0


def test_token_files(spark, docs, empty, tmp_path):
    library = tokens.load(WORD)
    ids = [library.encode(t or "", add_special_tokens=False).ids + [1] for _, t in ROWS]
    path = str(tmp_path / "orc")
    token_files.write(docs, path, WORD, 1)
    got = token_files.digests(spark, path).orderBy("start").collect()
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got[:-1]]).tolist()
    places = [float("-inf") if r.doc_id is None else r.doc_id for r in got]
    assert places == sorted(places)
    assert ordered((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == ordered(
        (i, len(x), crc(x)) for (i, _), x in zip(ROWS, ids))
    assert sorted(r.doc_id for r in token_files.find(spark, path, [500, -5]).collect()) == [-5, 500]
    token_files.write(empty, str(tmp_path / "none"), WORD, 1)
    assert token_files.digests(spark, str(tmp_path / "none")).count() == 0


def test_packing(spark, docs, empty):
    library = tokens.load(BYTE)
    left = {}
    for i, t in ROWS:
        left.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    got = packing.pack_documents(docs, BYTE, 2, 64).collect()
    assert sum(r.length for r in got) == sum(len(x) for xs in left.values() for x in xs)
    for r in got:
        assert any(crc(x[r.start:r.start + r.length]) == r.ids_crc32 and len(x) >= r.start + r.length for x in left[r.doc_id])
        assert r.length == 64 or r.piece == 0
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts[:-1]]).tolist()
        assert sum(n for _, n in parts) <= 64
    lengths = np.array([r.length for r in got])
    assert packing.lower_bound(lengths, 64) <= len(by) <= packing.lower_bound(lengths, 64) * 11 // 9 + 1
    assert packing.pack_documents(empty, BYTE, 2, 64).count() == 0


def test_packing_hands_over_between_groups(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(n)) for i, n in enumerate(rng.integers(1, 101, 3000))]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, length bigint"), 100, group_pieces=300).collect()
    assert sorted((r.doc_id, r.length) for r in got) == rows
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r.length)
    assert max(map(sum, by.values())) <= 100
    bound = packing.lower_bound(np.array([n for _, n in rows]), 100)
    assert bound <= len(by) <= bound * 1.03


@pytest.mark.parametrize("seed", range(4))
def test_lower_bound_is_one(seed):
    """No packing of a few pieces, found by trying all, needs fewer bins than the bound says."""
    rng = np.random.default_rng(seed)
    for _ in range(30):
        lengths = rng.integers(1, 21, int(rng.integers(1, 8)))

        def fewest(rest, rooms):
            if not rest:
                return len(rooms)
            n, best = rest[0], len(rooms) + len(rest)
            for r in {x for x in rooms if x >= n} | {20}:
                new = list(rooms)
                if r in new and r >= n:
                    new.remove(r)
                    new.append(r - n)
                else:
                    new.append(20 - n)
                best = min(best, fewest(rest[1:], new))
            if 20 in {x for x in rooms if x >= n}:
                best = min(best, fewest(rest[1:], [*rooms, 20 - n]))
            return best

        assert packing.lower_bound(lengths, 20) <= fewest(sorted(lengths.tolist(), reverse=True), [])


# ---- 8: language -----------------------------------------------------------------------------------------

def test_gradients_are_those_of_the_loss():
    net = language_id.Network(["a", "b", "c"], hidden=4)
    for cell in net.cells:
        cell.wx, cell.u, cell.b = (w.astype(np.float64) for w in (cell.wx, cell.u, cell.b))
    net.v, net.c = net.v.astype(np.float64), net.c.astype(np.float64)
    x = np.random.default_rng(0).integers(97, 100, (6, 5)).astype(np.uint8)
    y = np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -np.log(net.positions(x)[:, np.arange(6), y]).mean()

    for w, g in zip(net.weights(), net.gradients(x, y, np.ones(6))):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        was, w[i] = w[i], w[i] + 1e-2
        up = loss()
        w[i] = was - 1e-2
        down = loss()
        w[i] = was
        assert abs((up - down) / 2e-2 - g[i]) < 1e-3


def test_language_id(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = language_id.fit(docs)
    pred = {r.doc_id: r for r in language_id.predict(docs, net).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 for i, r in pred.items())
    tested = [i for i in pred if held_out(i)]
    assert np.mean([pred[i].lang_pred == truth[i] for i in tested]) > 0.9
    odd = table(spark, [(1, None), (2, ""), (3, "12 --- 34"), (None, "the of and"), (4, "¿。")])
    got = {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in language_id.predict(odd, net).collect()}
    assert {k: got[k][0] for k in (1, 2, 3, 4)} == dict.fromkeys((1, 2, 3, 4), "und") and not got[None][2]
    assert language_id.keep_languages(odd, net, 0.0).count() == 1
    assert language_id.predict(empty, net).count() == 0
    none = language_id.fit(empty)
    assert [r.lang_pred for r in language_id.predict(odd, none).collect()] == ["und"] * 5


def test_every_language_is_learned(spark, monkeypatch):
    """A language that few documents have is learned; null doc_ids do not crowd the others out."""
    monkeypatch.setattr(language_id, "TRAIN_DOCS", 5)
    seen = [i for i in range(30) if not held_out(i)]
    rows = [(None, f"the of and {i}", "en") for i in range(300)] + [(seen[0], "der die das und", "de"), (seen[1], "le la les et", "fr")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert language_id.fit(docs).langs == ["de", "en", "fr"]


def test_long_runs_are_read_whole():
    text = ("日本語" * 14).encode()                            # 126 bytes without a space
    assert language_id.runs(text) == [text]
    assert b"".join(language_id.runs(text * 5)) == text * 5


def test_extra_columns_are_there():
    assert all(c in SCHEMA for c in EXTRA)
