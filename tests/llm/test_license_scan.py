import random
import re
from functools import lru_cache

import duckdb
import pytest
from blotter.llm import license_scan
from blotter.llm.license_scan import LIKE, scan_licenses
from blotter.llm.license_templates import BASE_PHRASES, NOTICES
from blotter.llm.queries import op13_license_scan
from helpers import AWKWARD, docs
from pyspark.sql import functions as F

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(UP))


def lcs_row(a, words, at, longest):
    """(likeness, end) for every end of a span that starts at ``at``, by the textbook table."""
    row = [0] * (len(a) + 1)
    for b in range(at, min(at + longest, len(words))):
        new = [0]
        for j, x in enumerate(a):
            new.append(row[j] + 1 if x == words[b] else max(row[j + 1], new[j]))
        row = new
        yield 2 * row[-1] / (len(a) + b + 1 - at), b + 1


@lru_cache(maxsize=None)
def brute(text):
    words = split(text)
    places = sorted({(i, label) for label, phrase in BASE_PHRASES for i in range(len(words)) if words[i:i + len(split(phrase))] == split(phrase)})
    spans = []
    for k, (label, wording) in enumerate(NOTICES):
        m = split(wording)
        if len(set(m) & set(words)) < len(set(m)) - len(m) * 0.2223:
            continue  # more of its words are missing than a span may miss
        for at in range(len(words)):
            if words[at] in m:
                like, end = max(lcs_row(m, words, at, int(len(m) * 1.5) + 1), key=lambda x: (x[0], -x[1]))
                if like >= LIKE:
                    spans.append((-like, -len(m), at, k, end, label))
    stay = []
    for s in sorted(spans):
        if all(s[2] >= t[4] or s[4] <= t[2] for t in stay):
            stay.append(s)
    base = sorted({label for _, label in places})
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(base),
            ",".join(sorted({*base, *(s[5] for s in stay)})), 1.0 if places else max([-s[0] for s in stay], default=0.0))


COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def check(spark, rows, **kw):
    got = sorted((tuple(r) for r in scan_licenses(docs(spark, rows), **kw).select(*COLUMNS).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    return got


def edited(r, wording, edits):
    w = wording.split()
    for _ in range(edits):
        k = r.randrange(len(w))
        kind = r.choice("idr")
        w[k:k + (kind != "i")] = [] if kind == "d" else [r.choice(["the", "software", "gnu", "xyz", "4"])]
    return " ".join(w)


@pytest.mark.parametrize("max_bytes", [license_scan.MAX_BROADCAST_BYTES, 0])
def test_edited_notices(spark, max_bytes):
    r = random.Random(11)
    fill = "the of license licensed under a cc by gnu general public software permission is 2 0 é 中文".split()
    rows = []
    for i in range(120):
        parts = [" ".join(r.choices(fill, k=r.randint(0, 30)))]
        for _ in range(r.randint(0, 3)):
            label, wording = r.choice(NOTICES + BASE_PHRASES)
            parts += [edited(r, wording, r.randint(0, max(1, len(wording.split()) // 6))), " ".join(r.choices(fill, k=r.randint(0, 4)))]
        rows.append((i, r.choice([" ", "\n", ". "]).join(parts)))
    got = check(spark, rows, max_bytes=max_bytes)
    assert len({g[6] for g in got}) > 10


def test_a_notice_is_not_taken_for_its_neighbour(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0."), (2, "Licensed under CC BY 4.0."), (3, "Licensed under the GNU Lesser General Public License, v3"),
            (4, "This work is licensed under the GNU General Public License, version 3."), (5, "licensed under the xyz license"),
            (6, "Under the MIT  license; under the mit-license cc_by/nc"), (7, "cc by nc cc by nc"), (8, "under the mit")]
    got = {g[0]: g for g in check(spark, rows)}
    assert [got[i][6] for i in range(1, 9)] == ["cc-by-nc", "cc-by", "lgpl", "gpl", "", "cc-by-nc,mit", "cc-by-nc", ""]
    assert got[7][1:5] == (6, 2, 0, 3) and got[6][7] == 1.0


def test_awkward_rows(spark):
    notice = NOTICES[0][1]
    rows = [*AWKWARD, (20, "under the mit license " * 3000), (21, "x " * 70_000 + notice + " y" * 70_000), (21, "x " * 70_000 + notice + " y" * 70_000),
            (None, notice), (None, notice), (22, "中" * 300_000 + " cc by nc"), (23, notice + " " + notice), (23, "under the mit license"),
            (24, " under the mit license"), (25, "cc\tby\x7fnc")]
    check(spark, rows)
    assert scan_licenses(docs(spark, rows).limit(0)).count() == 0
    nulls = docs(spark, rows).withColumn("text", F.lit(None).cast("string"))
    assert {tuple(r)[1:8] for r in scan_licenses(nulls).collect()} == {(0, 0, None, None, "", "", 0.0)}


def test_texts_worked_on_in_parts(spark, monkeypatch):
    from blotter.llm import words
    r = random.Random(2)
    text = " ".join(r.choice(["cc", "by", "nc", "under", "the", "mit", "license"]) for _ in range(2000))
    monkeypatch.setattr(words, "PART_BYTES", 64)
    cut = license_scan.Words(text)
    assert cut.between(0, len(cut)) == [w.encode() for w in split(text)]
    monkeypatch.undo()
    assert (cut.grams() == license_scan.Words(text).grams()).all()


def test_query_on_the_whole_table(spark):
    rows = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    got = sorted((tuple(r) for r in op13_license_scan(spark, "/root/testdata/sf0.001").select(*COLUMNS).collect()), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)
