import random

from pyspark.sql import functions as F

from flowtide.llm import language


def texts(seed, syllables, n):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(40)) for _ in range(n)]


def test_copies_do_not_thin_the_sample(spark):
    once = spark.createDataFrame([(t, l) for l, s in (("xx", ["ba", "ko", "ti"]), ("yy", ["eln", "orm", "ast"])) for t in texts(l, s, 30)], "text string, lang string")
    copies = once.crossJoin(F.broadcast(spark.range(2000))).select("text", "lang")
    want = language.train(once).dictionaries
    assert set(want) == {"xx", "yy"} and language.train(copies).dictionaries == want


def test_letterless_texts_do_not_crowd_out_a_language(spark):
    rows = [(f"{i} !?", "xx") for i in range(500)] + [("ba ko ti", "xx"), ("eln orm", "yy")]
    d = spark.createDataFrame(rows, "text string, lang string")
    assert language.train(d).dictionaries == {"xx": b" ba ko ti ", "yy": b" eln orm "}


def test_no_label_is_left_out(spark):
    names = [f"l{k:03d}" for k in range(150)]
    d = spark.createDataFrame([(" ".join(texts(l, ["ba", "ko", "ti"], 3)), l) for l in names] + [("12", "no letters")], "text string, lang string")
    assert set(language.train(d).dictionaries) == set(names)
    small = language.train(d, together=150 * 600).dictionaries
    assert set(small) == set(names) and max(map(len, small.values())) == 600


def test_only_letters_are_letters(spark):
    assert language.letters("½ ² Ⅷ ① 12_%") == b"" and language.letters("a½B É ٣") == " a b é ".encode()
    d = spark.createDataFrame([("½ ²", "xx"), ("ba ko", "xx"), ("eln orm ast gro", "yy")], "text string, lang string")
    got = {r["text"]: r.language for r in language.identify(d, language.train(d)).collect()}
    assert got["½ ²"].lang_pred == "und" and got["½ ²"].score == 0 and got["eln orm ast gro"].lang_pred == "yy"


def test_shared_heads_do_not_fill_the_dictionaries(spark):
    """Texts that open with one long licence, and a text that has letters only at its end."""
    head = "permission is hereby granted free of charge to any person " * 40
    kinds = {"xx": ["ba", "ko", "ti", "shu"], "yy": ["eln", "orm", "ast", "gro"]}
    rows = [(head + " ".join(texts(f"{l}{i}", s, 40)), l) for l, s in kinds.items() for i in range(40)] + [("1 " * 3000 + "qu eau", "zz")]
    c = language.train(spark.createDataFrame(rows, "text string, lang string"))
    assert c.dictionaries["zz"] == b" qu eau "
    assert all(c.predict(t)[0] == l and c.predict(t)[2] > 0.05 for l, s in kinds.items() for t in texts(l, s, 20))
