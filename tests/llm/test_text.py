"""Token counts and coding against a tokenizer library, Ogg round trips, URL rules and ratio, language ID, mixing, the pipeline."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from .conftest import frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowtide.llm import language, media, mixing, topics, unigram, url_filter
from flowtide.llm.queries import MODEL, URL_RULES


@pytest.fixture(scope="module")
def vocabulary():
    return unigram.Vocabulary.read(MODEL)


@pytest.fixture(scope="module")
def reference(vocabulary):
    """The same vocabulary in another implementation of unigram models, whole texts at once."""
    from tokenizers import Tokenizer, models

    named = {i: (p, s) for p, s, i in vocabulary.pieces} | {i: (f"<0x{b:02X}>", 0.0) for b, i in enumerate(vocabulary.bytes_)}
    rows = [named.get(i, (f"\x00{i}", 0.0)) for i in range(max(named) + 1)]
    model = Tokenizer(models.Unigram(rows, unk_id=0, byte_fallback=True))
    return lambda t: model.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids if t else []


def ids_of(scanner, text):
    return np.frombuffer(scanner.encode(text), dtype=np.int32).tolist()


def test_tokens_and_coding(docs, texts, vocabulary, reference):
    d = unigram.decode(unigram.encode(unigram.count_tokens(docs, vocabulary), vocabulary), vocabulary, out="back")
    for r in d.collect():
        t = texts[r.doc_id]
        if t is None:
            assert r.n_tokens is None and r["ids"] is None and r.back is None
        else:
            assert r["ids"] == reference(t) and r.n_tokens == len(r["ids"]) and r.back == t.replace("▁", " ")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("the ofing \n\tàéß日😀▁.,0"), max_size=60) | st.text(max_size=40).filter(lambda s: "<" not in s))
def test_coding_of_any_text(text):
    v = unigram.Vocabulary.read(MODEL) if not hasattr(test_coding_of_any_text, "v") else test_coding_of_any_text.v
    test_coding_of_any_text.v = v
    s = unigram.scanner(v)
    ids = ids_of(s, text)
    assert s.count(text) == len(ids)
    assert s.decode(pa.array([ids], pa.list_(pa.int32()))) == [text.replace("▁", " ")]


def brute(pieces, unknown, s):
    """All segmentations; ties go to the one whose pieces, read from the end, are longest."""
    best = None

    def walk(end, score, lengths):
        nonlocal best
        if not end:
            best = max(best or (score, lengths), (score, lengths))
            return
        for n in range(1, end + 1):
            p = s[end - n : end]
            if p in pieces:
                walk(end - n, score + pieces[p], [*lengths, n])
            elif n == 1:
                walk(end - n, score + unknown, [*lengths, n])

    walk(len(s), 0.0, [])
    return best[1][::-1]


def test_ties_by_brute_force():
    pieces = {"▁": -1.0, "a": -1.0, "b": -1.0, "ab": -2.0, "aba": -3.0, "ba": -2.0, "▁a": -2.0}
    v = unigram.Vocabulary(tuple((p, s, i) for i, (p, s) in enumerate(pieces.items(), 1)), (), 0)
    s = unigram.Scanner(v)
    names = list(pieces)
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))
        want, at = [], 0
        for n in brute(pieces, -13.0, "▁" + text):
            want.append(names.index(("▁" + text)[at : at + n]) + 1)
            at += n
        assert ids_of(s, text) == want and s.count(text) == len(want)


def test_unknown_without_byte_pieces():
    v = unigram.Vocabulary((("▁", -1.0, 1), ("a", -1.0, 2)), (), 0)
    s = unigram.Scanner(v)
    assert ids_of(s, "axxa") == [1, 2, 0, 2] and s.count("axxa") == 4 and s.count("") == 0


def test_pieces_across_spaces():
    v = unigram.Vocabulary((("▁", -3.0, 1), ("a", -3.0, 2), ("a▁a", -1.0, 3)), (), 0)
    s = unigram.Scanner(v)
    assert not s.apart and ids_of(s, "a a") == [1, 3]


def test_empty_tables(empty, vocabulary):
    assert unigram.count_tokens(empty, vocabulary).count() == 0
    assert empty.select(media.media_digest(F.col("text"))).count() == 0
    assert language.identify(empty, language.train(empty)).count() == 0
    assert mixing.mix(empty, [mixing.Marginal("s", F.col("source"), {"s0": 1.0})], 0.5, F.length("text")).count() == 0
    pages = empty.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url"))
    assert url_filter.judge(pages, URL_RULES).count() == 0


# --- Ogg -----------------------------------------------------------------------------------------------------------


def slow_crc(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def test_crc():
    for n in (0, 1, 27, 300):
        data = random.Random(n).randbytes(n)
        assert media.page_crc(data) == slow_crc(data)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 255, 4096, 4097, 8192, 65025, 255 * 255, 300_000])
def test_ogg_round_trip(n):
    raw = random.Random(n).randbytes(n)
    payload = media.padded(raw)
    assert len(payload) % 64 == 0 and len(payload) >= 64
    streams = media.read(media.write(payload))
    assert media.payload_of(streams) == payload
    for s in streams.values():
        ends = np.cumsum([len(p) for p in s.packets[1:]]) / media.RATE
        assert s.times[0] == 0 and s.times[1:] == pytest.approx(ends.tolist() or [])


def test_ogg_damage():
    good = media.write(media.padded(b"x" * 70_000))
    rng = random.Random(3)
    for _ in range(60):
        bad = bytearray(good)
        bad[rng.randrange(len(bad))] ^= 1 << rng.randrange(8)
        with pytest.raises(ValueError):
            media.payload_of(media.read(bytes(bad)))
    for cut in (5, 100, len(good) // 2, len(good) - 1):
        with pytest.raises(ValueError):
            media.read(good[:cut])


def test_packet_that_goes_on_over_pages():
    packets = [b"a" * 70_000, b"b" * 255, b"", b"c"]
    pages = media._data_pages(1, packets)
    head = media._page(1, 0, media.FIRST, 0, b"\1", b"h")
    assert media.read(head + b"".join(pages))[1].packets[1:] == packets and len(pages) > 1


def test_media_columns(docs, texts):
    rows = docs.select("doc_id", media.media_digest(F.col("text")).alias("m"), media.from_media(media.to_media(F.col("text"))).alias("back")).collect()
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        payload = media.padded(raw)
        assert bytes(r.back) == payload and r.m.n_bytes == len(raw) and r.m.payload_bytes == len(payload)
        assert r.m.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.m.tail_crc32 == zlib.crc32(payload[-64:])
        assert r.m.media_sha256 == hashlib.sha256(media.write(payload)).hexdigest()
    by_text = collections.defaultdict(set)
    for r in rows:
        by_text[texts[r.doc_id]].add(tuple(r.m))
    assert all(len(v) == 1 for v in by_text.values())


# --- URLs ----------------------------------------------------------------------------------------------------------


def brute_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_urls(spark):
    rng = random.Random(5)
    urls = [None, "", "no scheme", "http://", "http://COM/en/x", "http://É.Example.COM/en/7?q=1", "x://a.net/de/9#f://b", "http://example.net/de/81", "http://notexample.com/en/7", "http://h?p=/en/", "http://a\nb.com/en/\n1", "x" * 50_000, "http://a.com/en/" + "9" * 50_000]
    for i in range(600):
        good = rng.random() < 0.5
        host = rng.choice(["a.example.com", "b.net"] if good else ["b.com", "c.org", "example.net"])
        path = rng.choice(["/en/7", "/de/1"] if good else ["/en/1", "/es/4", "/de/8"])
        urls.append(f"https://{host}{path}{rng.choice(['articles', 'reading'] if good else ['casino', 'spam'])}/{i}")
    urls += urls[:10] + ["https://fresh.dev/articles/reading/1", "https://fresh.dev/casino/spam/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("mine"))
    got = {r.page_id: r.url_filter for r in url_filter.judge(pages, URL_RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = split_url(u)
        rule = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule.text), u
        assert got[i].verdict == rule.verdict if rule else got[i].verdict in ("allow", "block")
    assert got[len(urls) - 2].verdict == "allow" and got[len(urls) - 1].verdict == "block"


def test_ratio_against_written_out_probabilities():
    """Witten-Bell estimates by counting substrings of the training URLs, for every character of a URL."""
    good, bad = ["abba.com/en", "abc.de/x", "abba.de"], ["zz.com", "zab.org/en"]

    def p(urls, context, c):
        seen = [u[k + len(context)] for u in (url_filter.START + u + url_filter.END for u in urls) for k in range(len(u) - len(context)) if u.startswith(context, k) and k + len(context) > 0]
        shorter = p(urls, context[1:], c) if context else 1 / url_filter.ALPHABET
        return (seen.count(c) + len(set(seen)) * shorter) / (len(seen) + len(set(seen))) if seen else shorter

    def log(urls, url):
        u = url_filter.START + url + url_filter.END
        return sum(math.log(p(urls, u[max(0, i - url_filter.ORDER) : i], u[i])) for i in range(1, len(u)))

    ratio = url_filter.Ratio(good, bad)
    for url in ("abba.com/en/1", "zz.org", "q", "zab.de/x?abc"):
        assert ratio.score(url) == pytest.approx((log(good, url) - log(bad, url)) / (len(url) + 1), rel=1e-9)


def test_markov_sums_to_one_and_calibrates():
    m = url_filter.Markov(["abab", "abc", "b"], 3)
    seen = set("abc") | {url_filter.END, url_filter.START}
    for context in ("", "a", "ab", "zz", "ba"):
        known = sum(m.p(context, c) for c in seen)
        assert known + (url_filter.ALPHABET - len(seen)) * m.p(context, "unseen") == pytest.approx(1)
    r = url_filter.Ratio(["good/read"] * 5, ["bad/spam"] * 5).calibrate(["good/reading"], ["bad/spams"])
    assert r.score("good/x") > r.threshold > r.score("bad/spam/y") and r.score(None) == 0.0
    assert url_filter.Ratio([], ["x"]).score("x") == 0.0


# --- language ------------------------------------------------------------------------------------------------------


def tongue(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language(spark):
    rng = random.Random(2)
    kinds = {"xx": ["ba", "ko", "ti", "shu", "re"], "yy": ["eln", "orm", "ast", "ü", "gro"], "zz": ["qu", "eau", "ç", "oi", "lle"]}
    rows = [(i, tongue(rng, kinds[l], rng.randrange(20, 80)), l) for i, l in enumerate(rng.choice(list(kinds)) for _ in range(500))]
    rows += [(1000, None, "xx"), (1001, "123 !?", "xx"), (1002, "", None), (1003, tongue(rng, kinds["xx"], 60_000), None), (None, "ba ko", "xx")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("margin", F.lit("mine"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    got = {r.doc_id: r for r in language.identify(d, language.train(d, where=~F.coalesce(held, F.lit(False)))).collect()}
    test = [(i, l) for i, _, l in rows[:500] if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(test) > 100 and sum(got[i].language.lang_pred == l for i, l in test) >= 0.98 * len(test)
    assert all(got[i].language.lang_pred == "und" and got[i].language.rejected and got[i].language.score == 0 for i in (1000, 1001, 1002))
    assert got[1003].language.lang_pred == "xx" and all(0 <= r.language.score <= 1 for r in got.values())
    assert got[3].margin == "mine"


def test_prediction_by_plain_compression(spark):
    """The smallest sum over blocks of a fresh compressor's output, for every text."""
    import zstandard

    rng = random.Random(12)
    kinds = {"xx": ["ba", "ko", "ti"], "yy": ["eln", "orm", "ast"], "zz": ["qu", "eau", "oi"]}
    rows = [(i, tongue(rng, kinds[l], rng.randrange(1, 900)), l) for i, l in enumerate(rng.choice(list(kinds)) for _ in range(60))]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    c = language.train(d)
    got = {r.doc_id: r.language for r in language.identify(d, c).collect()}
    for i, t, _ in rows:
        raw, sizes = language.letters(t), {}
        for l, dictionary in c.dictionaries.items():
            z = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[l] = sum(len(z.compress(raw[k : k + language.BLOCK])) for k in range(0, len(raw), language.BLOCK))
        first, second = sorted(sizes.values())[:2]
        assert got[i].lang_pred == min(sizes, key=lambda l: (sizes[l], l)) and got[i].margin == pytest.approx((second - first) / first)


def test_language_ties_and_few_languages():
    same = language.Classifier({"b": b"abc def ", "a": b"abc def "})
    assert same.predict("abc def")[0] == "a" and same.predict("abc def")[2] == 0
    assert language.Classifier({"a": b"x"}).predict("word") == ("a", 1.0, 1.0)
    assert language.Classifier({}).predict("word")[0] == "und"


# --- mixing --------------------------------------------------------------------------------------------------------


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(0, 40))), rng.choice(["en", "en", "en", "de", None]), rng.choice(["s0", "s0", "s0", "s1", "s2", "rare"])) for i in range(4000)]
    rows += [(5000, None, "en", "s0"), (5000, None, "en", "s0"), (None, "a b", "de", "s1")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("p", F.lit("mine"))
    marginals = [mixing.Marginal("lang_level", F.col("lang"), {"en": 0.5, "de": 0.4}), mixing.Marginal("source_level", F.col("source"), {"s0": 0.3, "s1": 0.4, "s2": 0.2, "absent": 0.2})]
    n_words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != ""))
    got = mixing.mix(d, marginals, 0.4, n_words).collect()
    assert len(got) == len(rows) and {r.p for r in got} == {"mine"}
    m = [r.mixing for r in got]
    n = [len((t or "").split()) for _, t, _, _ in rows]
    assert sorted(x.n_tokens for x in m) == sorted(n)
    total = sum(n)
    for level, want in (("en", 0.5), ("de", 0.4), (mixing.OTHER, 0.1)):
        assert sum(x.weight * x.n_tokens for x in m if x.lang_level == level) == pytest.approx(want * total, rel=1e-6)
    shares = {"s0": 0.3 / 0.9, "s1": 0.4 / 0.9, "s2": 0.2 / 0.9}  # `absent` has no tokens, and nothing is left for others
    for level, want in shares.items():
        assert sum(x.weight * x.n_tokens for x in m if x.source_level == level) == pytest.approx(want * total, rel=1e-6)
    assert sum(x.p * x.n_tokens for x in m) == pytest.approx(0.4 * total, rel=1e-6) and all(0 <= x.p <= 1 for x in m)
    assert sum(x.n_tokens for x in m if x.kept) == pytest.approx(0.4 * total, rel=0.1)


def test_mixing_against_a_plain_loop(spark):
    """Raking and calibration written out over documents, with a level so scarce that its probability is 1."""
    rng = random.Random(8)
    rows = [(i, f"t{i}", rng.choice("aaaaaaaab"), rng.choice("xxy"), rng.randrange(1, 9)) for i in range(900)]
    d = spark.createDataFrame(rows, "doc_id long, text string, u string, v string, n long")
    targets = [("u", {"a": 0.6, "b": 0.4}), ("v", {"x": 0.5, "y": 0.5})]
    got = {r.doc_id: r.mixing for r in mixing.mix(d, [mixing.Marginal(c, F.col(c), t) for c, t in targets], 0.5, F.col("n"), without=("n",)).collect()}
    weight, total = [1.0] * len(rows), sum(r[4] for r in rows)
    for _ in range(300):
        for c, (_, target) in zip((2, 3), targets):
            now = collections.Counter()
            for r, w in zip(rows, weight):
                now[r[c]] += w * r[4]
            weight = [w * target[r[c]] * total / now[r[c]] for r, w in zip(rows, weight)]
    low, high = 0.0, 1e6
    for _ in range(200):  # the scale at which capped probabilities give the budget
        middle = (low + high) / 2
        low, high = (middle, high) if sum(min(1, w * middle) * r[4] for r, w in zip(rows, weight)) < 0.5 * total else (low, middle)
    p = [min(1, w * low) for w in weight]
    assert max(p) == 1
    kept = sum(x * r[4] for x, r in zip(p, rows))
    for r, w, x in zip(rows, weight, p):
        assert got[r[0]].weight == pytest.approx(w, rel=1e-6) and got[r[0]].p == pytest.approx(x, rel=1e-6)
        assert got[r[0]].reached_u == pytest.approx(sum(y * q[4] for y, q in zip(p, rows) if q[2] == r[2]) / kept, rel=1e-6)
    assert len({r.p for r in got.values()}) >= 3 and any(r.kept for r in got.values())


def test_topics(spark):
    rng = random.Random(6)
    kinds = [["rock", "song", "drum", "band"], ["goal", "ball", "team", "win"], ["oil", "fry", "salt", "pan"]]
    rows = [(i, " ".join(rng.choice(kinds[i % 3]) for _ in range(30))) for i in range(90)] + [(90, None), (91, " \n ")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    model = topics.learn(d, topics=3)
    got = {r.doc_id: r.a for r in d.select("doc_id", topics.assigner(d, model)(F.col("text")).alias("a")).collect()}
    assert len({(i % 3, got[i].topic) for i in range(90)}) == 3 and all(got[i].n_words == 30 for i in range(90))
    assert got[90].topic == got[91].topic == topics.NONE and got[91].n_words == 0
    # against distances written out for each text
    for i, t in rows[:30]:
        table, _ = topics.counts([t])
        v = model.vectors(table)[0]
        assert got[i].topic == f"topic{max(range(3), key=lambda k: sum(a * b for a, b in zip(v, model.centres[k])))}"
    none = topics.learn(d.where("doc_id > 200"))
    assert none.of(["a b"])[0] == [topics.NONE] and len(topics.fit(["same text"] * 5, 4).centres) <= 1


def test_raking_and_caps():
    cells = {("a", "x"): 90, ("a", "y"): 10, ("b", "x"): 5, ("b", "y"): 45, ("c", "y"): 0}
    ms = [mixing.Marginal("u", F, {"a": 0.5, "b": 0.5}), mixing.Marginal("v", F, {"x": 0.4, "y": 0.6})]
    f = mixing.rake(cells, ms)
    w = {k: f[k] * cells[k] for k in f}
    assert w[("a", "x")] + w[("a", "y")] == pytest.approx(75) and w[("a", "x")] + w[("b", "x")] == pytest.approx(60)
    odds = lambda c: c[("a", "x")] * c[("b", "y")] / (c[("a", "y")] * c[("b", "x")])
    assert odds(w) == pytest.approx(odds(cells))  # raking keeps the association
    p = mixing.calibrate(cells, f, 0.9)
    assert max(p.values()) <= 1 and sum(p[k] * n for k, n in cells.items()) == pytest.approx(0.9 * 150)
    assert mixing.rake({}, ms) == {} and mixing.calibrate({("a", "x"): 0}, {}, 0.3) == {("a", "x"): 0.3}


# --- pipeline ------------------------------------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    kinds = {"en": ["the", "ing", "ed", "ou", "th"], "de": ["und", "sch", "ü", "ei", "zu"]}
    texts = []
    for i in range(120):
        texts.append("\n".join(tongue(rng, kinds[("en", "de")[i % 2]], 30) for _ in range(5)))
    texts += [texts[0], texts[1] + " extra", None, "", "123"]
    d = frame(spark, texts, extra=False).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    d.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        counts.append((name, out.count()))
        if name != "sentencepiece":
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        docs = out
    kept = dict(counts)
    assert kept["language_id"] == 122 and kept["line_dedup"] == 122 and kept["ngram_join"] <= 121
    assert docs.where("not round_trip").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == kept["sentencepiece"]


def test_pipeline_on_odd_tables(spark, tmp_path):
    """No rows; and rows that repeat, clash in names or hold nulls in every column."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long, found string, row string, line_dedup string, mixing string, language string"
    rng = random.Random(3)
    rows = [(i, tongue(rng, [["the", "ing", "ed"], ["und", "sch", "ei"]][i % 2], 60), ["en", "de"][i % 2], "s", 1, "mine", "mine", "mine", "mine", "mine") for i in range(40)]
    rows += rows[:5] * 2 + [(None,) * 10, (None, rows[0][1], None, None, None, None, None, None, None, None)]
    for name, data in (("none", []), ("odd", rows)):
        at = tmp_path / name
        spark.createDataFrame(data, schema).write.parquet(str(at / "documents.parquet"))
        docs = spark.read.parquet(str(at / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(at))
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
            assert {r.found for r in docs.select("found").collect()} <= {"mine", None}
        out = corpus_pipeline.run(spark, str(at))
        assert out.columns == ["doc_id", "lang", "source", "ids", "n_ids", "round_trip"] and (out.count() == 0) == (not data)


def test_vocabularies_that_differ_in_the_middle_have_two_scanners(vocabulary):
    pieces = list(vocabulary.pieces)
    k = len(pieces) // 2
    pieces[k] = (pieces[k][0], pieces[k][1] - 5, pieces[k][2])
    assert unigram.Vocabulary(tuple(pieces), vocabulary.bytes_, vocabulary.unk).key != vocabulary.key


def test_coding_keeps_columns_that_have_inner_names(spark, vocabulary):
    d = spark.createDataFrame([("a b", "mine", "mine", "mine")], "text string, __coded string, row string, coded string")
    r = unigram.encode_and_decode(d, vocabulary).first()
    assert (r["__coded"], r["row"], r["coded"], r["decoded"]) == ("mine", "mine", "mine", "a b")


def test_slices_bound_rows_and_bytes_and_keep_all():
    from flowtide.llm.common import slices

    texts = pa.array(["a" * 10, None, "", "b" * 90, "c" * 5, "é" * 3, None, "d"])
    for rows, size in ((1, 1), (2, 1000), (1000, 20), (1000, 1 << 20)):
        parts = list(slices(texts.slice(1), rows, size))
        assert [x for p in parts for x in p.to_pylist()] == texts.to_pylist()[1:]
        assert all(1 <= len(p) <= rows for p in parts)
        assert all(len(p) == 1 or sum(len((x or "").encode()) for x in p.to_pylist()) <= size for p in parts)
    assert list(slices(pa.array([], pa.string()))) == []
