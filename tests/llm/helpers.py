"""Fixtures shared by the tests of the training-data operators."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Columns whose names the operators use themselves.
CLASHING = "size long, kept string, component_id string, fp string, x long, rid string, node string, k string, host int, part int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING


def words(text):
    return WORD.findall(text or "")


def docs_frame(spark, rows, parts=3):
    """Rows (doc_id, text) or (doc_id, text, source) as documents with clashing extra columns."""
    full = []
    for r in rows:
        doc_id, text, source = r if len(r) == 3 else (*r, "s0")
        full.append((doc_id, text, "en", source, None if text is None else len(text), 1, "k", "c", "f", 2, "r", "n", "q", 3, 4))
    df = spark.createDataFrame(full, DOCS)
    return df.repartition(parts) if rows else df


def components(nodes, linked):
    """Brute-force union-find: node -> smallest node reachable."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}
