"""Small tables with the cases that every operator has to handle, and plain versions of the operators' rules."""

from __future__ import annotations

import re

import xxhash

LONG = "lorem ipsum dolor sit amet " * 8000
COPY = "one text that several rows share\nwith a second line of words"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
EXTRA = "h long, fp string, digest string, copies string, size string, score string, spans string, part string, low string, component_id string"

ROWS = [
    (1, "alpha beta gamma delta epsilon", "en", "b", 1), (2, COPY, "en", "a", 2), (3, COPY, "en", None, 3), (4, None, "de", "a", None),
    (5, "", None, "a", 0), (6, LONG, "fr", "a", 6), (7, LONG + "x", "fr", "c", 7), (None, COPY, "en", "b", 8), (None, None, None, None, None),
    (None, "only without an id", "en", "b", 9), (8, "the same row twice", "en", "d", 10), (8, "the same row twice", "en", "d", 10),
    (9, "an id with two texts", "en", "a", 11), (9, "an id with two texts, the other", "en", "b", 12), (10, "\n\n \t\n", "es", "é", 13),
    (11, "wörter mit ümläuten 😀 " * 40, "de", "\U00010000", 14), (12, "a" * 5000, "en", "a", 15), (13, "Alpha BETA gamma delta epsilon", "en", "b", 16),
]


def docs(spark, rows=ROWS, extra=True):
    d = spark.createDataFrame(rows, DOCS)
    if extra:
        for c in EXTRA.split(", "):
            name, kind = c.split()
            d = d.selectExpr("*", f"cast({'7' if kind == 'long' else repr('x')} as {kind}) as {name}")
    return d.repartition(3)


def written(spark, path, rows=ROWS, pages=(), labels=()):
    """A folder of tables as the queries read them."""
    docs(spark, list(rows)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(pages), "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text, k=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, most=2):
    """Representative of each fingerprint's class, by comparing all pairs."""
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= most:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def spans_text(spans):
    return ",".join(":".join(map(str, s)) for s in spans)
