"""Small document tables with every awkward case, and plain-Python versions of the contracts."""

import hashlib
import random
import re
import zlib
from collections import Counter

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, kept string, chunk bigint"
#: extra columns whose names the operators use inside
EXTRA = ("row", "kept", "chunk")

WORDS = [a + b for a in ("ba", "ti", "lo", "mur", "Sen", "é") for b in ("ra", "ne", "kos", "lin", "", "ß")]


def prose(rng, n):
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]))
    return " ".join(out)


def documents(seed=1, n=60):
    """Rows (doc_id, text): unique, copies, near copies, shared passages, empty, null, ties and long ones."""
    rng = random.Random(seed)
    passage = prose(rng, 40)
    base = prose(rng, 120)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            text = prose(rng, rng.randint(1, 90))
        elif kind == 1:
            text = base
        elif kind == 2:
            words = base.split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif kind == 3:
            text = prose(rng, 20) + " " + passage + "\n" + prose(rng, 15)
        elif kind == 4:
            text = base.replace(" ", "  ").replace(",", "\t") if i % 12 == 4 else base.upper()
        else:
            text = ["", None, " \n\t", "x", "a b", "a " * 30, " \x1c.,,", "aaaa" * 40][(i // 6) % 8]
        rows.append((i * 3 % 101, text))
    rows += [(None, base), (None, None), (7, passage), (7, passage), (7, "other " + passage), rows[0],
             (500, prose(rng, 3000)), (501, (passage + " ") * 30), (-5, passage)]
    return rows


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "r", "k", 7) for i, t in rows], SCHEMA)


def stored(spark, rows, tmp_path, parts=3):
    """The rows as a table of several files."""
    path = str(tmp_path / "documents.parquet")
    table(spark, rows).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def place(doc_id):
    return float("inf") if doc_id is None else doc_id


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def brute_substrings(units, rows, width, join, spans=False):
    """Removal of windows of ``width`` units that a smaller doc_id holds; ``units``: text -> list."""
    split, first = [units(t) for _, t in rows], {}
    for (i, _), u in zip(rows, split):
        for a in range(len(u) - width + 1):
            key = tuple(u[a:a + width])
            first[key] = min(first.get(key, float("inf")), place(i))
    out = []
    for (i, _), u in zip(rows, split):
        gone = [False] * len(u)
        for a in range(len(u) - width + 1):
            if first[tuple(u[a:a + width])] < place(i):
                gone[a:a + width] = [True] * width
        kept = [x for x, g in zip(u, gone) if not g]
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(u), sum(gone), *((runs,) if spans else ()), sha(join(kept))))
    return ordered(out)


def token_sets(rows, n):
    sets = []
    for _, t in rows:
        w = space_words(lower(t or ""))
        sets.append({tuple(w[a:a + n]) for a in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return sets


def brute_components(rows, n, num, den):
    """For each row, the number of its component."""
    sets = token_sets(rows, n)
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and den * common >= num * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    return [root(x) for x in range(len(rows))], sets


def brute_decontamination(rows, items, n=13):
    grams = {}
    for item, t in items:
        w = alnum_words(t)
        k = min(n, len(w))
        for a in range(len(w) - k + 1 if k else 0):
            grams.setdefault(tuple(w[a:a + k]), set()).add(str(item))
    out = []
    for i, t in rows:
        w, hit, found = alnum_words(t), set(), set()
        for k in {len(g) for g in grams}:
            for a in range(len(w) - k + 1):
                if tuple(w[a:a + k]) in grams:
                    hit |= set(range(a, a + k))
                    found |= grams[tuple(w[a:a + k])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return ordered(out)


def crc(ids):
    return zlib.crc32(b"".join(int(x).to_bytes(4, "little") for x in ids))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def counted(rows):
    return Counter(map(repr, rows))
