"""Quality rules against a plain version; the statistics against plain counting."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_fixtures import SCHEMA, documents, ordered, prose, space_words

from docsift.llm import quality_rules as Q


def rows(seed=5):
    """(doc_id, text, lang, source): large, small and tiny groups, junk, null language and source."""
    rng = random.Random(seed)
    out = []
    for i in range(420):
        lang, source = rng.choice([("en", "a")] * 6 + [("en", "b"), ("de", "a"), ("de", None), (None, "a"), (None, None)])
        text = prose(rng, rng.randint(30, 200))
        if i % 7 == 0:
            text = text.replace(" ", "### ")
        if i % 11 == 0:
            text = "\n".join([text, "same line here", "same line here", " ", " ", text[:40]])
        out.append((i % 400, text, lang, source))
    out += [(i, t, "en", "a") for i, t in documents()[:40]] + [(None, prose(rng, 90), "en", "a"), (7, None, None, None),
                                                               (8, prose(rng, 80) + "\n" + "long " * 30_000, "fr", "x")]
    return out


def statistics(text):
    text = text or ""
    words = space_words(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, lines = set(), 0
    for line in text.split("\n"):
        lines += bool(space_words(line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(inside)


def floored(x):
    return math.floor(x * Q.GRID + 0.5)


def expected(table, least, tail):
    stats = [statistics(t) for _, t, _, _ in table]
    failed = [s[0] < 50 or 100 * s[4] > 50 * s[0] for s in stats]
    sizes = Counter((lang, source) for (_, _, lang, source), f in zip(table, failed) if not f)
    few = Counter()
    for (lang, _), n in sizes.items():
        few[lang] += n if n < least else 0
    rest = sum(n for (lang, _), n in sizes.items() if n < least and few[lang] < least)
    members, group = defaultdict(list), {}
    for k, ((_, _, lang, source), f) in enumerate(zip(table, failed)):
        if not f:
            group[k] = ((lang, source) if sizes[lang, source] >= least else (lang,) if few[lang] >= least
                        else "all" if rest >= least else None)
            members[group[k]].append(k)
    cut, far = Q.quantile(tail), {}
    for name, ks in members.items():
        if name is None:
            continue
        q = np.array([[floored(math.log(s[0])), floored(math.log(s[1] / s[0])), floored(math.asin(math.sqrt(s[2] / s[1]))),
                       floored(math.asin(math.sqrt(s[4] / s[0]))), floored(math.log(s[3] + 1))] for s in (stats[k] for k in ks)])
        half = (len(ks) + 1) // 2 - 1
        centre = np.sort(q, axis=0)[half]
        u = q - centre
        scale = np.maximum(np.sort(np.abs(u), axis=0)[half] * 1.4826, np.array(Q.LEAST_SCALES) * Q.GRID)
        limit = np.floor(scale * Q.CUT)

        def estimate(x):
            square = (x.T @ x / len(x) - np.outer(x.mean(0), x.mean(0))) / np.outer(scale, scale)
            square = (1 - Q.RIDGE) * square + Q.RIDGE * np.eye(Q.FEATURES)
            return x.mean(0) / scale, np.linalg.inv(square), np.linalg.slogdet(square)[1]

        def distances(mean, inverse, _):
            z = u / scale - mean
            return np.einsum("ni,ij,nj->n", z, inverse, z)

        ends = []
        for start in ((np.zeros(Q.FEATURES), np.eye(Q.FEATURES), None), estimate(u), estimate(np.clip(u, -limit, limit))):
            now, first = start, True
            while True:
                bucket = np.minimum(np.floor(np.sqrt(np.maximum(distances(*now), 0)) * Q.FINE), Q.BUCKETS - 1)
                limit_bucket = np.sort(bucket)[math.ceil(Q.SHARE * len(ks)) - 1]
                new = estimate(u[bucket <= limit_bucket])
                if not first and not new[2] < now[2] - 1e-6:
                    break
                now, first = new, False
            ends.append(now)
        best = min(ends, key=lambda e: e[2])
        d = np.maximum(distances(*best), 0)
        bucket = np.minimum(np.floor(np.sqrt(d) * Q.FINE), Q.BUCKETS - 1)
        unit = max(((np.sort(bucket)[half] + 0.5) / Q.FINE) ** 2, Q.RIDGE) / Q.quantile(0.5)
        far |= dict(zip(ks, d / unit))
    return [(i, *s, f, not f and far.get(k, 0.0) <= cut) for k, ((i, _, _, _), s, f) in enumerate(zip(table, stats, failed))], far


def stored(spark, table, tmp_path):
    path = str(tmp_path / "docs.parquet")
    spark.createDataFrame([(i, t, lang, source, None, "r", "k", 7) for i, t, lang, source in table], SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("least", [30, 10_000])
def test_quality_rules(spark, tmp_path, monkeypatch, least):
    monkeypatch.setattr(Q, "LEAST", least)
    table = rows()
    want, far = expected(table, least, Q.TAIL)
    got = Q.quality_rules(stored(spark, table, tmp_path)).drop("distance")
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert ordered(got.collect()) == ordered(want)
    rejected = sum(not r[6] and not r[7] for r in want)
    assert rejected > 20 if least == 30 else rejected == 0 and not far


def test_junk_is_rejected_and_prose_stays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "LEAST", 30)
    table = rows()
    got = {r.doc_id: r for r in Q.quality_rules(stored(spark, table, tmp_path)).collect()}
    junk = [i for i, t, _, _ in table[:400] if "###" in t and not got[i].base_failed]
    clean = [i for i, t, _, _ in table[:400] if "###" not in t and "\n" not in t and not got[i].base_failed]
    assert not any(got[i].kept for i in junk) and sum(got[i].kept for i in clean) > 0.99 * len(clean)


def test_all_alike_and_empty(spark, tmp_path):
    """Vectors without any spread, and none at all."""
    alike = stored(spark, [(i, "one two three four five six " + " ".join(f"w{k}" for k in range(60)), "en", "a") for i in range(150)], tmp_path)
    assert Q.quality_rules(alike).filter("kept").count() == 150
    assert Q.quality_rules(alike.filter("doc_id < 0")).count() == 0


def test_statistics_of_long_texts(monkeypatch):
    monkeypatch.setattr(Q, "BLOCK", 16)
    texts = [t or "" for _, t in documents()]
    got = list(zip(*(x.tolist() for x in Q._statistics([t.encode() for t in texts]))))
    assert got == [statistics(t) for t in texts]
    assert Q._statistics([]) [0].tolist() == []


def test_packed_numbers_do_not_overflow():
    big = 1 << 33
    a, b = np.array([0, big - 1, big - 1, 5]), np.array([1, 2, 2, 1])
    once = Q._packed(a, b, big)
    twice = Q._packed(once, b, big)
    assert len(set(twice.tolist())) == 3 and twice[1] == twice[2]


def test_quantiles():
    # median and 95 % point of the chi-square distribution with five degrees of freedom
    assert abs(Q.quantile(0.5) - 4.35146) < 1e-4 and abs(Q.quantile(0.05) - 11.0705) < 1e-4
