import random

from pyspark.sql import functions as F

from cdclake.llm import secrets

from . import corpus

KEYS = "0123456789abcdef"


def made(seed=8):
    rng = random.Random(seed)
    random_hex = lambda n: "".join(rng.choice(KEYS) for _ in range(n))
    rows = []
    for k in range(120):
        words = corpus.prose(rng, "aa", 50).split(" ")
        at = rng.randrange(len(words))
        if k % 4 == 0:
            words.insert(at, f'token = "{random_hex(40)}"')
        elif k % 4 == 1:
            words.insert(at, "AKIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16)))
        elif k % 4 == 2:
            words.insert(at, "4" + "".join(rng.choice("0123456789") for _ in range(15)))
        rows.append((k, " ".join(words), "aa", "src1", 1))
    return rows


def test_secrets_are_told_from_numbers(spark):
    rows = made()
    table = spark.createDataFrame(rows, corpus.SCHEMA).withColumn("digest", F.lit("x"))
    got = secrets.scan(table).collect()
    assert len(got) == 90
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        string = texts[r.doc_id][r.start : r.start + r.length]
        assert r.secret == (not string.isdigit()) and 0 <= r.score <= 1


def test_redaction_changes_secrets_only(spark):
    rows = made()
    table = spark.createDataFrame([*rows, *rows[:2]], corpus.SCHEMA).withColumn("digest", F.lit("x"))
    out = secrets.redact(table)
    assert out.columns == table.columns
    got = out.collect()
    assert len(got) == 122
    texts = {i: t for i, t, *_ in rows}
    for r in got:
        if r.doc_id % 4 < 2:
            before, after = r.text.split(secrets.MASK)
            assert texts[r.doc_id].startswith(before) and texts[r.doc_id].endswith(after)
        else:
            assert r.text == texts[r.doc_id]


def test_plan_has_no_python(spark):
    table = spark.createDataFrame(made(), corpus.SCHEMA)
    for df in (secrets.scan(table), secrets.redact(table)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_odd_rows(spark, docs, no_docs):
    assert secrets.scan(docs).count() == 0
    assert sorted(map(repr, secrets.redact(docs).collect())) == sorted(map(repr, docs.collect()))
    assert secrets.scan(no_docs).count() == 0 and secrets.redact(no_docs).count() == 0
    odd = spark.createDataFrame([(None, "abcdef123456 " * 3000, None, None, None), (1, "12345678901234", None, None, None)], corpus.SCHEMA)
    assert secrets.scan(odd).count() == 3001


def test_assigned_values_of_any_form_are_found(spark):
    values = ["hunter2abc", "Tr0ub4dor&3xyz", "P@ss!word-1", "aBcDeFgHiJkLmN", "correcthorsebattery", "it's'me", "73519824", "s3cr3t"]
    forms = ['password = "{}"', "token={}", "PASSWORD: {},", "'api_key': '{}'}}", "pwd := {}."]
    rows, expected = made(), {}
    for k, value in enumerate(values):
        for f, form in enumerate(forms):
            expected[1000 + 10 * k + f] = value
            rows.append((1000 + 10 * k + f, f"some words {form.format(value)} and more", "aa", "src1", 1))
    rows.append((2000, "the token: abc, and password is not given; secret = 12, my word", "aa", "src1", 1))
    table = spark.createDataFrame(rows, corpus.SCHEMA)
    texts = {i: t for i, t, *_ in rows}
    got = [r for r in secrets.scan(table).filter("doc_id >= 1000").collect()]
    assert sorted((r.doc_id, texts[r.doc_id][r.start : r.start + r.length]) for r in got) == sorted(expected.items())
    # Whether a word or a number is a secret is for the forest to say; the others are.
    plain = ("correcthorsebattery", "73519824")
    assert all(r.secret for r in got if expected[r.doc_id] not in plain)
    clean = {r.doc_id: r.text for r in secrets.redact(table).filter("doc_id >= 1000").collect()}
    for k, value in expected.items():
        assert value in plain or clean[k] == texts[k].replace(value, secrets.MASK)
    assert clean[2000] == texts[2000]


def test_assigned_plain_strings_are_not_taught_as_harmless(spark):
    rows = [(1, "token = 12345678901234 or 12345678901234", "aa", "src1", 1)]
    found = secrets.findings(spark.createDataFrame(rows, corpus.SCHEMA))
    assert [(r.number, r.label) for r in secrets.labelled_by_form(found).collect()] == [(1, 0.0)]


def test_labelled_findings_may_be_given(spark):
    table = spark.createDataFrame(made(), corpus.SCHEMA)
    labels = secrets.findings(table).withColumn("label", F.col("candidate").rlike("^[0-9]+$").cast("double"))
    got = secrets.scan(table, labelled=labels)
    assert got.filter("secret").count() == 30


def test_long_names_quotes_and_names_that_are_candidates(spark):
    texts = {
        1000: ("x DATABASE_PASSWORD_FOR_PRODUCTION: Tr0ub4dor&3xyz y", "Tr0ub4dor&3xyz"),
        1001: ("x GITHUB_PERSONAL_ACCESS_TOKEN=hunter2abcdef y", "hunter2abcdef"),
        1002: ("x password=\"a'b'c'd'e'f'g'h'i'j'k'lmnop1\" y", "a'b'c'd'e'f'g'h'i'j'k'lmnop1"),
        1003: ("x password=" + "a'1" * 20000 + " y", "a'1" * 20000),
    }
    rng = random.Random(4)
    parts = ["MAXIMUM", "CONNECTION", "RETRY", "TIMEOUT", "DATABASE", "PRODUCTION", "PERSONAL", "BUFFER", "SETTINGS"]
    names = [(500 + k, f"x {'_'.join(rng.sample(parts, 4))} y", "aa", "src1", 1) for k in range(40)]
    rows = made() + names + [(k, t, "aa", "src1", 1) for k, (t, _) in texts.items()]
    table = spark.createDataFrame(rows, corpus.SCHEMA)
    got = [r for r in secrets.scan(table).collect() if r.doc_id >= 1000 and r.secret]
    assert {r.doc_id: texts[r.doc_id][0][r.start : r.start + r.length] for r in got} == {k: v for k, (_, v) in texts.items()}
    before = {r.doc_id: r.before for r in secrets.findings(table).filter("doc_id = 1001 AND number = 1").collect()}
    assert before == {1001: "x GITHUB_PERSONAL_ACCESS_TOKEN="}
    clean = {r.doc_id: r.text for r in secrets.redact(table).filter("doc_id >= 1000").collect()}
    assert clean == {k: t.replace(v, secrets.MASK) for k, (t, v) in texts.items()}
