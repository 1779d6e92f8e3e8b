"""Quality rules and personal data against plain Python over whole texts."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from riskloom.llm import personal_data, quality_rules

BLANK = r"[\x20\x09-\x0D]+"


def words(text):
    return [w for w in re.split(BLANK, text or "") if w]


def statistics(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = collections.Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def plan_has_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return any(x in plan for x in ("Python", "Pandas", "InArrow"))


@pytest.mark.parametrize("table", ["documents", "odd_docs", "clashing", "no_docs"])
def test_statistics_and_base_verdict(request, table, labels):
    docs = request.getfixturevalue(table)
    rows, _ = quality_rules.judged(docs, labels)
    assert not plan_has_python(rows)
    got = collections.Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in rows.collect()
    )
    expected = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        s = statistics(r.text)
        expected[(r.doc_id, *s, s[0] < 50 or 100 * s[4] > 50 * s[0])] += 1
    assert got == expected


def test_many_repeats_take_the_sorting_way(spark):
    text = " ".join(f"w{i % 40}" for i in range(400)) + " " + " ".join(f"u{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = quality_rules.with_statistics(docs).first()
    assert got.n_repeat_words == statistics(text)[4] > 0


def test_learned_list_rejects_bad_and_keeps_good(spark):
    good = [(i, " ".join(f"word{(i * 31 + k * 7) % 997}" for k in range(60 + i % 40))) for i in range(300)]
    bad = [(1000 + i, " ".join(f"word{(i * 17 + k * 5) % 991}***" for k in range(60 + i % 40))) for i in range(150)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad], "doc_id bigint, quality int")
    rows, rules = quality_rules.judged(docs, labels)
    assert rules.rules
    got = {r.doc_id: r.kept for r in rows.collect()}
    assert all(got[i] for i, _ in good)
    assert not any(got[i] for i, _ in bad)


def test_growing_follows_the_information_gain():
    cells = {"a": [(10, 90), (90, 10)], "b": [(50, 50), (50, 50)]}
    cuts = {"a": [1.0], "b": [2.0]}
    assert quality_rules._best_condition(cells, cuts, 5) == quality_rules.Condition("a", True, 1.0)


def test_without_labels_only_base_rules_hold(odd_docs, no_labels):
    rows, rules = quality_rules.judged(odd_docs, no_labels)
    assert not rules.rules
    assert rows.where("kept = base_failed").count() == 0


def test_keep_good_returns_the_rows_unchanged(clashing, labels):
    kept = quality_rules.keep_good(clashing, labels)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, None}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for order, (kind, pattern) in enumerate(
        [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
        ]
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


TRICKY = [
    "a@b.c_d@e.f.g x 1.2.3.4.5.6.7.8 1.2.3.999 00000255.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111 4111111111111112 4111 1111  1111 1111",
    "+1 2 +123456789 +1 (171) 555-2028. ++49 30 1234567 +4111 1111 1111 1111",
    "a@b a@b@c.d .@x.y %@-.- é@x.y 😀 x@y.z",
    "1-1-1-1-1-1-1-1-1-1-1-7 x1.1.1.1x 12.34.56.78.",
]


@pytest.mark.parametrize("table", ["documents", "odd_docs", "clashing", "no_docs", "tricky"])
def test_base_spans(request, spark, table):
    if table == "tricky":
        docs = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id bigint, text string")
    else:
        docs = request.getfixturevalue(table)
    found = personal_data.find_personal_data(docs, carry=["doc_id", "text"])
    assert not plan_has_python(found)
    rows = found.select("row.*", personal_data.span_names(F.col("base")).alias("names")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["names"] == base_spans(r["text"]), r["doc_id"]


def test_long_runs_take_linear_time(spark):
    text = "a" * 300_000 + "1" * 300_000 + " x@y.zz " + "+" * 1000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = personal_data.find_personal_data(docs)
    names = found.select(personal_data.span_names(F.col("base")).alias("s")).first().s
    assert names == f"email:{600_001}:{600_007}"


def contextual_docs():
    """Twelve valid cards behind the same words, three that fail the check sum, and one number elsewhere."""
    from itertools import count, islice

    valid = list(islice((f"4{i:015d}" for i in count(7) if luhn(f"4{i:015d}")), 12))
    wrong = [f"4{i:015d}" for i in (100, 201, 302) if not luhn(f"4{i:015d}")]
    docs = [(i, f"please charge card {n} today") for i, n in enumerate(valid)]
    docs += [(100 + i, f"please charge card {n} today") for i, n in enumerate(wrong)]
    docs.append((200, "the parcel number 4000000000000999 was lost"))
    docs.append((300, f"it reads {wrong[0]} on the back"))
    return docs, wrong


def test_contexts_discover_what_the_patterns_miss(spark):
    rows, wrong = contextual_docs()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = personal_data.find_personal_data(docs, carry=["doc_id"])
    got = {r.doc_id: [x.text for x in r.found] for r in found.select("row.doc_id", "found").collect()}
    assert all(got[100 + i] == [n] for i, n in enumerate(wrong))
    # An accepted instance is marked wherever it stands; another number is not.
    assert got[300] == [wrong[0]]
    assert got[200] == []
    assert all(got[i] == [] for i in range(12))


UNSEEN = {
    "phone": (["+1 (171) 555-20%02d" % i for i in range(8)], ["555-123-4567", "(555) 123 4567", "five-five-five"]),
    "email": (["ann%d@mail.example.com" % i for i in range(8)], ["bob(at)example.com", "carol"]),
    "ip": (["10.0.0.%d" % i for i in range(8)], ["fe80::1ff:fe23", "10.0.0.999"]),
    "card": (["4111 1111 1111 1111", "4012888888881881", "5555555555554444", "5105105105105100", "378282246310005"],
             ["4111 1111 1111 1112", "MCXXVIII"]),
}


@pytest.mark.parametrize("kind", sorted(UNSEEN))
def test_contexts_alone_reach_unseen_forms(spark, kind):
    seeds, unseen = UNSEEN[kind]
    texts = [f"then please reach {x} without delay" for x in [*seeds, *unseen]]
    texts += [f"nothing to see at {w} today" for w in ("noon", "home", "555-000", "sea")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = personal_data.find_personal_data(docs, carry=["doc_id", "text"])
    rows = found.select("row.*", "found").orderBy("doc_id").collect()
    assert not plan_has_python(found)
    for r in rows:
        assert all(r.text[x.start : x.end] == x.text for x in r.found)
    got = [[(x.kind, x.text) for x in r.found] for r in rows]
    assert got == [[]] * len(seeds) + [[(kind, x)] for x in unseen] + [[]] * 4
    clean = [r.text for r in personal_data.redact(docs).orderBy("doc_id").collect()]
    assert clean[: -4] == [f"then please reach [{kind.upper()}] without delay"] * (len(seeds) + len(unseen))


def test_accepted_instances_make_new_contexts(spark):
    """Seeds behind "reach"; names found there stand behind "badge"; what else stands there is found from those names."""
    names, last = ["alba", "bruno", "carla", "dario"], ["emil", "fritz"]
    texts = [f"then please reach ann{i}@mail.example.com without delay" for i in range(12)]
    texts += [f"then please reach {n} without delay" for n in names]
    texts += [f"who wears badge {n} inside" for n in [*names, *last]]
    texts += ["emil was here", "the word inside alone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = personal_data.find_personal_data(docs, carry=["doc_id"], accept=0.75)
    got = [[x.text for x in r.found] for r in found.orderBy("row.doc_id").collect()]
    assert got == [[]] * 12 + [[n] for n in [*names, *names, *last]] + [["emil"], []]


def test_tokens_in_a_row_have_contexts(spark):
    text = "ids 12345678 23456788"
    base = personal_data.base_spans(F.lit(text))
    rows = spark.range(1).select(F.col("id").alias("row_id"), F.lit(text).alias("text"), base.alias("base"))
    got = {r.instance: (r.two, r.one, r.right) for r in personal_data.units(rows).collect()}
    assert got["23456788"] == ("ids", "12345678", "")
    mails = "ids ann@x.com bob@y.com end"
    spans = spark.range(1).select(personal_data.base_spans(F.lit(mails)).alias("b")).first().b
    assert [(s.left, s.right) for s in spans][1] == ("ids ann@x.com ", " end")


def test_units_are_cut_from_the_staged_bare_texts_once(spark, tmp_path):
    """No pass of a round makes the bare texts again, nor cuts them a second time to see that there are units."""
    texts = spark.createDataFrame(enumerate([*TRICKY, "", "(call) +1 (171) 555-2028, please!"]), "row_id bigint, text string")
    based = texts.withColumn("base", personal_data.base_spans(F.col("text")))
    based.withColumn("bare", personal_data.bare(F.col("text"), F.col("base"))).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    found = personal_data.units(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and plan.lower().count("split(") == 2
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, personal_data.units(rows.drop("bare")).collect()))


def test_signs_at_edges_are_those_of_the_plain_pattern(spark):
    plain = rf"(?:(?<=[\x20\x09-\x0D])|\G){personal_data.SIGN}|{personal_data.SIGN}(?={personal_data.SIGN}{{0,16}}+(?:[\x20\x09-\x0D]|$))"
    numbers = random.Random(4)
    texts = ["".join(numbers.choice("a1 .,;()(12)\"'|~\t+-@é") for _ in range(numbers.randrange(40))) for _ in range(3000)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    both = docs.select(*[F.regexp_replace("text", p, "#").alias(c) for c, p in (("a", plain), ("b", personal_data.EDGE))])
    assert both.where("a <> b").count() == 0


def test_redaction(clashing):
    out = personal_data.redact(clashing)
    assert out.columns == clashing.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[11].text == "write to [EMAIL] or call [PHONE] from [IP]"
    assert rows[11].n_chars == len(rows[11].text)
    assert rows[4].text is None and rows[4].n_chars is None
    assert out.count() == clashing.count()


def test_span_digest_of_nothing():
    empty = hashlib.sha256(b"").hexdigest()
    assert empty.startswith("e3b0c442")
