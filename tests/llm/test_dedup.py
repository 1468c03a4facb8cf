"""Exact, line, substring and near-copy dedup against brute force."""

import collections
import hashlib
import random
import re

import pytest

from pyspark.sql import functions as F

from flowtide.llm import exact_dedup, line_dedup, ngram_join, substring_dedup

WS = re.compile(r"[\x20\x09-\x0D]+")


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("words_a_row", [8, 1, 1e-9])
def test_exact_dedup(docs, texts, words_a_row):
    """A filter of one word lets all rows through; the result is the same."""
    got = by_id(exact_dedup.decide(docs, words_a_row=words_a_row).collect())
    groups = collections.defaultdict(list)
    for i, t in enumerate(texts):
        groups[WS.sub(" ", t or "")].append(i)
    assert len(got) == len(texts)
    for t, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (min(ids), len(ids), i == min(ids), sha(t))


def test_exact_dedup_odd_rows(odd, empty):
    got = exact_dedup.decide(odd).collect()
    same = [r for r in got if r.group_size == 3]
    assert len(same) == 3 and sum(r.kept for r in same) == 1 and all(r.keep_id == 5 for r in same)
    assert exact_dedup.decide(empty).count() == 0


def brute_chunks(text, min_chars):
    """Lines without the repeats of runs, parted where the hash of a pair of neighbours is a local minimum."""
    lines = text.split("\n")
    lines = [x for k, x in enumerate(lines) if k == 0 or x != lines[k - 1] or len(x) < min_chars]
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    q = [line_dedup.PRIME if a == b else (a * 31 + b) % line_dedup.PRIME for a, b in zip(h, h[1:])]
    starts = [0] + [j + 1 for j in range(1, len(q) - 1) if q[j] < min(q[j - 1], q[j + 1])]
    return [lines[a:b] for a, b in zip(starts, [*starts[1:], len(lines)])]


@pytest.mark.parametrize("min_chars", [1, 32])
def test_line_dedup(docs, texts, min_chars):
    got = by_id(line_dedup.dedup_lines(docs, min_chars=min_chars).collect())
    seen = set()
    for i, t in enumerate(texts):
        if t is None:
            assert got[i]["text"] is None and got[i].line_dedup.n_lines == 0
            continue
        kept = []
        for c in brute_chunks(t, min_chars):
            key = "\n".join(c)
            if len(c) > 1 and len(key) - len(c) + 1 >= min_chars:
                if key in seen:
                    continue
                seen.add(key)
            kept += c
        assert (got[i].line_dedup.n_lines, got[i].line_dedup.n_removed) == (t.count("\n") + 1, t.count("\n") + 1 - len(kept))
        assert got[i]["text"] == "\n".join(kept)
    assert any(r.line_dedup.n_removed for r in got.values())
    assert got[3]["n"] == "mine"


def test_line_dedup_finds_shifted_passages(spark):
    block = [f"line number {k} of a passage that moves" for k in range(40)]
    rows = [(1, "\n".join(block)), (2, "\n".join(["something before", *block, "after"]))]
    got = by_id(line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got[1].line_dedup.n_removed == 0 and got[2].line_dedup.n_removed > 25


def test_line_dedup_odd_rows(odd, empty):
    assert line_dedup.dedup_lines(empty).count() == 0
    assert line_dedup.dedup_lines(odd).count() == odd.count()


def brute_substring(rows, window=20):
    seen, out = set(), {}
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if key in seen:
                gone[k : k + window] = [True] * window
            seen.add(key)
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


def test_levels():
    assert substring_dedup.levels(20) == [5, 10, 20] and substring_dedup.levels(7) == [7] and substring_dedup.levels(40) == [5, 10, 20, 40] and substring_dedup.levels(12) == [6, 12]


@pytest.mark.parametrize("window,bucket_bytes", [(20, 8 << 20), (20, 4000), (12, 500), (7, 100_000)])
def test_substring_dedup(docs, texts, window, bucket_bytes):
    """Also with hundreds of buckets, whose number no longer fits a byte."""
    got = by_id(substring_dedup.remove(docs, window=window, bucket_bytes=bucket_bytes).collect())
    want = brute_substring(enumerate(texts), window)
    assert len(got) == len(texts)
    for i, w in want.items():
        s = got[i].substring_dedup
        assert (s.n_words, s.n_removed, s.kept) == w, i


def test_substring_dedup_finds_a_table_that_changes(docs):
    with pytest.raises(Exception, match="not the same when it was read again"):
        other = F.udf(lambda t: f"{t} {random.random()}").asNondeterministic()
        shaky = docs.select("doc_id", other("text").alias("text"))
        substring_dedup.remove(shaky).collect()
    with pytest.raises(ValueError, match="integer"):
        substring_dedup.remove(docs, doc_id="lang")


def test_substring_dedup_odd_rows(odd, empty):
    assert substring_dedup.remove(empty).count() == 0
    got = substring_dedup.remove(odd).collect()
    assert len(got) == odd.count()
    # the null doc_id comes first, so its copy stays and the rows that repeat it lose all
    removed = sorted((r.doc_id is not None, r.substring_dedup.n_removed) for r in got if r.text and r.text.startswith("k0") and r.doc_id != 2)
    assert removed == [(False, 0), (True, 40), (True, 40)]


def brute_groups(texts, threshold=0.8):
    sets = {i: ngram_join.shingles(t) for i, t in enumerate(texts)}
    classes = collections.defaultdict(list)
    for i, s in sets.items():
        if len(s):
            classes[s.tobytes()].append(i)
    reps = {min(v): v for v in classes.values()}
    parent = {r: r for r in reps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    ids = sorted(reps)
    members = {r: set(sets[r].tolist()) for r in ids}
    for a in ids:
        for b in ids:
            if a < b:
                k = len(members[a] & members[b])
                if k >= threshold * len(members[a] | members[b]):
                    links[a] += 1
                    links[b] += 1
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (find(r), r, len(v), links[r]) for r, v in reps.items() for i in v}


@pytest.mark.parametrize("limit,block,tokens", [(64, 384, 1 << 20), (2, 4, 1 << 20), (64, 384, 150)])
def test_ngram_join(docs, texts, limit, block, tokens, monkeypatch):
    """Also with buckets split as far as they go, and searched block against block, by rows and by size."""
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", tokens)
    got = by_id(ngram_join.join(docs, limit=limit, block=block).collect())
    want = brute_groups(texts)
    assert len(got) == len(texts)
    assert max(w[3] for w in want.values()) >= 12
    for i in range(len(texts)):
        g = (got[i].class_id, got[i].copy_id, got[i].copies, got[i].n_links)
        assert g == want.get(i, (i, i, 1, 0)), i
    assert sum(r.keep for r in got.values()) == len({w[0] for w in want.values()}) + len(texts) - len(want)


def test_ngram_join_drops_and_odd_rows(docs, texts, odd, empty):
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.keep for r in ngram_join.join(docs).collect())
    assert ngram_join.join(empty).count() == 0 and ngram_join.drop_near_copies(empty).count() == 0
    assert ngram_join.join(odd).count() == odd.count()


def test_runs_and_agreement():
    assert ngram_join.runs_for(0.8, 0.999) == 10
    assert 10 < ngram_join.least_agreement(30, 0.8) < 20


def test_components(spark):
    edges = [(i, i + 1) for i in range(59) if i % 20 != 19] + [(100, 200), (200, 300)]
    got = {r.u: r.label for r in ngram_join.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: i // 20 * 20 for i in range(60)} | {100: 100, 200: 100, 300: 100}
