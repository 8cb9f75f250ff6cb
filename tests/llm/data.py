"""Small tables and brute-force versions for the operator tests."""

import collections
import re
import zlib

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def prose(seed, n):
    """n invented words, the same for the same seed."""
    out, x = [], seed
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2 ** 31
        out.append("".join("aeioubdglmnrst"[(x >> s) % 14] for s in (3, 7, 11, 15, 19)))
    return " ".join(out)


def edge_docs():
    """Nulls in every column, empty, blank and long texts, ties, repeated rows."""
    base = prose(7, 60)
    rows = [
        (1, base, "en", "s1", 10),
        (2, base.replace(" ", "  "), "en", "s2", 10),      # equal up to white space
        (2, base.replace(" ", "  "), "en", "s2", 10),      # the same row again
        (3, base + " tail", "en", None, 10),               # near copy
        (4, None, "en", "s1", None),
        (5, "", None, "s1", 0),
        (6, " \t\n\x0b\f\r", "en", "s1", 6),
        (None, prose(9, 30), "en", "s1", 5),
        (None, None, None, None, None),
        (7, "x" * 30_000, "en", "s1", 30_000),
        (8, prose(11, 6_000), "en", "s1", 1),
        (9, "Ünïcödé 中文 🙂 AKIA" + "Z" * 16, "de", "s1", 1),
        (10, "two words", "en", "s1", 9),
    ]
    return rows


CLASH = {"kept": "1", "KEEP_ID": "2", "group_size": "3", "score": "4", "spans": "'5'", "component_id": "6",
         "n_shingles": "7", "ids": "8", "hits": "9", "y": "10", "_x_row": "11", "block": "12", "train": "13",
         "start": "14", "n_live": "15", "rank": "16", "node": "17"}


def with_clashes(df):
    return df.selectExpr("*", *[f"{v} AS `{k}`" for k, v in CLASH.items()])


def components(sets, percent):
    """Smallest key reachable over links, by comparing all pairs."""
    keys = [k for k, s in sets.items() if s]
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def shingles(text, k):
    w = words(text)
    return frozenset(zip(*[w[i:] for i in range(k)], strict=False)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def by(rows, key):
    out = collections.defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out
