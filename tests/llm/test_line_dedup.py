"""Line deduplication (13) against a brute-force version."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from credlake.llm import line_dedup

from .conftest import prose

SPACE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars, min_docs):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))

    held = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            held[k].append(i)
    out = []
    for i, text in rows:
        lines, stay = (text or "").split("\n"), []
        for x in lines:
            ids = held[key(x)]
            common = len(key(x)) >= min_chars and len(ids) >= min_docs
            known = [j for j in ids if j is not None]
            if not common or i == (max(known) if known else None):
                stay.append(x)
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return Counter(out)


def got(docs, **kw):
    return Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.line_dedup(docs, **kw).collect())


def mixed(rng):
    common = [prose(rng, 14), "  " + prose(rng, 12) + "\t", "É" * 45 + " İstanbul ß", "日本" * 21]
    texts = [None, "", "\n", "\n\n\n", "x" * 39, "y" * 40, " \t" + "z" * 39 + " \r"]
    for _ in range(60):
        lines = [rng.choice([*common, prose(rng, 9), "", "short", "y" * 40, rng.choice(common).upper()]) for _ in range(rng.randint(1, 12))]
        texts.append("\n".join(lines))
    return texts + ["\n".join([common[0]] * 500 + ["own line of the long document, of forty characters or more"])]


def test_line_dedup(make_docs):
    texts = mixed(random.Random(13))
    for min_docs in (1, 2, 5):
        assert got(make_docs(texts, extra=True), min_docs=min_docs) == brute(list(enumerate(texts)), 40, min_docs)


def test_lines_of_repeated_and_null_ids(make_docs):
    line = "the same forty characters stand in all of these"
    texts = [line, line, line + "\nmore", line, line, line, None]
    for ids in ([1, 2, 3, 3, None, None, 9], [None] * 7, [5] * 7, [7, 6, 5, 4, 3, 2, 1]):
        assert got(make_docs(texts, ids)) == brute(list(zip(ids, texts)), 40, 5)


def test_line_dedup_empty(make_docs):
    assert line_dedup.line_dedup(make_docs([])).count() == 0
    assert line_dedup.line_dedup(make_docs([None, None])).count() == 2


def test_line_dedup_is_native(make_docs):
    plan = line_dedup.line_dedup(make_docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
