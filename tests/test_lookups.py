"""Pattern joins, recodes and the rule chain against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from strataload.functions import scalar
from strataload.operators import lookup, recode
from strataload.plans import rules


def words(rng, n, letters="ab*%_", longest=4):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_prefix_lookup_is_the_or_join(spark, seed):
    rng = random.Random(seed)
    values = words(rng, 30, "ab%_", 5) + [None]
    patterns = words(rng, 12) + [None, "*", "a*"]
    got = lookup.prefix_lookup(
        spark.createDataFrame([(v,) for v in values], "v string"),
        "v",
        spark.createDataFrame([(p, f"t{i}") for i, p in enumerate(patterns)], "p string, tag string"),
        "p",
    )
    want = set()
    for v in set(values) - {None}:
        for i, p in enumerate(patterns):
            if p is not None and (v.startswith(p.replace("*", "")) if "*" in p else v == p):
                want.add((v, f"t{i}"))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_prefix_lookup_on_lists(spark):
    lists = spark.createDataFrame([("a1^b2^^c",), (None,), ("a1",)], "codes string")
    patterns = spark.createDataFrame([("a*", 1), ("c", 2)], "p string, n int")
    got = lookup.prefix_lookup(lists, "codes", patterns, "p", sep="^")
    assert {tuple(r) for r in got.collect()} == {("a1", 1), ("c", 2)}


@pytest.mark.parametrize("seed", range(3))
def test_contains_lookup_takes_the_best(spark, seed):
    rng = random.Random(seed)
    names = words(rng, 40, "aAbB%", 6) + [None, ""]
    patterns = [
        (rng.choice(["pattern", "Exact", "EXACT ", "other"]), p, rng.choice([None, 1, 2, 3]))
        for p in words(rng, 12, "aAbB%", 3) + ["ab", ""]
    ]
    got = lookup.contains_lookup(
        spark.createDataFrame([(n,) for n in names], "name string"),
        "name",
        spark.createDataFrame(patterns + [("pattern", None, 0)], "kind string, text string, prio int"),
        "text",
        "kind",
        "prio",
    )
    want = {}
    for n in set(names) - {None}:
        hits = []
        for kind, text, prio in patterns:
            how = kind.strip().lower()
            if (how == "pattern" and text.lower() in n.lower()) or (how == "exact" and text == n):
                hits.append((prio is None, prio or 0, text, kind))
        if hits:
            want[n] = min(hits)
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r["prio"] is None, r["prio"] or 0, r["text"]) == want[r["name"]][:3]


def test_contains_lookup_on_all_scripts_and_lengths(spark):
    many = [chr(0x4E00 + i) + "a" for i in range(0, 3300, 3)]  # more than come to the driver
    few = [chr(0x400 + 7 * i) + chr(0x1F600 + 3 * i) for i in range(25)] + ["?b", "\U0001f600b", "[", "\\E.*", "a\nb"]
    long = ["x" * 20 + "y", "x" * 19 + "yz", "é" * 16 + "1", "Z" * 40]
    names = [a + b for a in few for b in ("", "b", "\U0001f600")] + [f"-{p}-" for p in [*many, *few, *long]]
    names += ["\U0001f603b", "\U0001f600", chr(0x4E01) + "a", "x" * 30, "é" * 16 + "2", "x" * 25 + "Yz", "", "a\rb"]
    patterns = [("pattern", p, i % 5) for i, p in enumerate([*many, *few, *long])]
    got = lookup.contains_lookup(
        spark.createDataFrame([(n,) for n in names], "name string"), "name",
        spark.createDataFrame(patterns, "kind string, text string, prio int"), "text", "kind", "prio",
    )
    want = {n: min(hits) for n in names if (hits := [(i, p.encode()) for _, p, i in patterns if p.lower() in n.lower()])}
    assert {r["name"]: (r["prio"], r["text"].encode()) for r in got.collect()} == want


def test_long_names_make_rows_for_real_hits_only(spark):
    """Rows that a name's pieces make: not one per character."""
    names = spark.createDataFrame([(f"{i} " + "lorem ipsum (dolor) " * 3000 + "The End",) for i in range(8)], "name string")
    patterns = [("pattern", p, i) for i, p in enumerate(["the", "or", "the end", "q7", "ipsum [", "7"])]
    got = lookup.contains_lookup(names, "name", spark.createDataFrame(patterns, "kind string, text string, prio int"), "text", "kind", "prio")
    assert [r["text"] for r in got.collect()] == ["the"] * 8
    todo, made = [got._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        made += node.metrics().get("numOutputRows").get().value() if kind == "GenerateExec" else 0
        inner = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else None
        todo += [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]
    assert 0 < made <= 8 * len(patterns)


def test_null_safe_and_filtered_lookup(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, k string")
    side = spark.createDataFrame([(None, "nil"), ("a", "A")], "k string, v string")
    out = lookup.null_safe_lookup(df, side, {"k": "k"}, {"v": "v"})
    assert {tuple(r) for r in out.collect()} == {(1, None, "nil"), (2, "a", "A"), (3, "b", None)}
    out = lookup.filtered_lookup(df, side, ("k", "k"), "v", "w", "v = 'nil'")
    assert {tuple(r) for r in out.collect()} == {(1, None, None), (2, "a", None), (3, "b", None)}


def test_validity_join_is_closed(spark):
    facts = spark.createDataFrame([(1, "2020-01-31"), (1, "2020-02-01"), (1, "2019-12-31"), (2, "2020-01-01")], "k int, d string")
    facts = facts.select("k", F.col("d").cast("date").alias("add_date"))
    versions = spark.createDataFrame([(1, "x", "2020-01-01", "2020-01-31"), (1, "y", "2020-02-01", "9999-12-31")], "k int, v string, a string, b string")
    versions = versions.select("k", "v", F.col("a").cast("date").alias("add_date"), F.col("b").cast("date").alias("delete_date"))
    out = lookup.validity_join(facts, versions, {"k": "k"}, outputs={"v": "v"})
    got = {(r["k"], str(r["add_date"]), r["v"]) for r in out.collect()}
    assert got == {(1, "2020-01-31", "x"), (1, "2020-02-01", "y"), (1, "2019-12-31", None), (2, "2020-01-01", None)}


def test_shared_joins_are_planned_once(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    side = spark.createDataFrame([(1, "x", "y"), (2, "p", "q")], "id int, u string, v string")
    specs = [("s", {"a": "id"}, "u", "au"), ("s", {"b": "id"}, "u", "bu"), ("s", {"a": "id"}, "v", "av")]
    out = lookup.assign_from_lookups(df, {"s": side}, specs)
    assert out.first().asDict() == {"a": 1, "b": 2, "au": "x", "av": "y", "bu": "p"}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2


@pytest.mark.parametrize("seed", range(2))
def test_recode_multi_value(spark, seed):
    rng = random.Random(seed)
    lists = ["^".join(rng.choice(["a", "b", "c", "d", "", " "]) for _ in range(rng.randint(1, 5))) for _ in range(40)]
    lists += [None, "a^a^b", "c"]
    hidden = ["a", "c", None, "a"]
    df = spark.createDataFrame(list(enumerate(lists)), "id int, codes string")
    out = recode.recode_multi_value(df, "codes", spark.createDataFrame([(h,) for h in hidden], "code string"), "code")
    for r in out.collect():
        old = lists[r["id"]]
        new = None if old is None else "^".join(x for x in old.split("^") if x not in ("a", "c"))
        assert r["codes"] == (None if new is None or new.strip(" ") == "" else new)
    assert out.count() == len(lists)


def test_restricted_names_keep_their_number(spark):
    rows = [(1, "Alpha Care", "Org 1"), (2, None, "Org 2"), (3, "Plain", " "), (4, "Plain", "beta inc"), (5, "Plain", None)]
    df = spark.createDataFrame(rows, "id int, plan string, org string")
    restricted = spark.createDataFrame(
        [("pattern", "alpha", 1, "P<x>", None), ("pattern", "beta", 2, "Q<x>", "O<x>"), ("exact", "Org 2", 1, "R<x>", "S<x>")],
        "match_type string, name_pattern string, priority int, plan_name string, organization_name string",
    )
    dictionary = recode.update_name_dictionary(df, ["plan", "org"], restricted, None)
    ids = {r["name"]: r["id"] for r in dictionary.collect()}
    assert ids == {n: i + 1 for i, n in enumerate([None, " ", "Alpha Care", "Org 1", "Org 2", "Plain", "beta inc"])}
    columns = {"plan": "plan_name", "org": "organization_name"}
    out = {r["id"]: r for r in recode.recode_restricted(df, columns, restricted, dictionary, "flag").collect()}
    assert (out[1]["plan"], out[1]["org"], out[1]["flag"]) == ("P3", None, 1)
    assert (out[2]["plan"], out[2]["org"], out[2]["flag"]) == (None, "S5", 1)
    assert (out[3]["plan"], out[3]["org"], out[3]["flag"]) == ("Plain", " ", 0)
    assert (out[4]["plan"], out[4]["org"], out[4]["flag"]) == ("Q6", "O7", 1)
    assert (out[5]["plan"], out[5]["org"], out[5]["flag"]) == ("Plain", None, 0)
    more = df.unionByName(spark.createDataFrame([(6, "Aaa", "Zzz")], df.schema))
    grown = recode.update_name_dictionary(more, ["plan", "org"], restricted, dictionary)
    again = {r["name"]: r["id"] for r in grown.collect()}
    assert {n: again[n] for n in ids} == ids and (again["Aaa"], again["Zzz"]) == (8, 9)


@pytest.mark.parametrize(
    "text, want",
    [
        ("March 2020", "032020"), ("jan/feb 2019", "012019"), ("Sept/Oct", "09"), ("sep/oct", "09/10"),
        ("September/October 2001", "092001"), ("Sept 2011", "092011"), ("DEC/JAN__2020", "122020"),
        ("mar.-07", "03-07"), ("12,_May,,2020", "12052020"), ("", ""), (None, None), ("x  y 7", "7"),
        ("Augustus", "08"), ("januaryfebruary", "0102"),
    ],
)
def test_month_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalar.month_text(F.col("t"))).first()[0] == want


@pytest.mark.parametrize(
    "pattern, text, want",
    [("a*c", "abbc", True), ("a?c", "abc", True), ("a?", "a", False), ("a?", "ab", True), ("*", "", True),
     ("a.c", "abc", False), ("*b*", "abc", True), ("ab", "abc", False), ("a*", "a\nb", True)],
)
def test_wildcard(spark, pattern, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(scalar.wildcard(F.col("t"), pattern)).first()[0] is want


def test_long_values(spark):
    df = spark.createDataFrame([(["abcde", None],), (["abcdef"],), (None,), ([],)], "v array<string>")
    assert [r[0] for r in df.select(scalar.has_long_value(F.col("v"))).collect()] == [False, True, False, False]


def test_functions_in_rule_text(spark):
    scalar.register_sql_functions(spark, {"has_long_value": "any_long"})
    df = spark.createDataFrame([(1, "Sept/Oct 2001"), (2, "may,_x sep/oct")], "id int, v string")
    steps = [rules.Rule("element", "m", "month_text(t.v)"), rules.Rule("element", "l", "any_long(split(t.v, ' '))", order=1)]
    out = rules.apply_rules(df, steps, {}, "t").orderBy("id").collect()
    assert [(r["m"], r["l"]) for r in out] == [("092001", True), ("0509/10", True)]
    both = df.select(scalar.month_text(F.col("v")).alias("a"), F.expr("month_text(v)").alias("b"))
    assert both.filter("a <> b").count() == 0


def test_rule_chain_sees_earlier_steps(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "id int, v string")
    look = spark.createDataFrame([("X", "hit")], "code string, word string")
    steps = [
        rules.Rule("element", "w", "l.word", order=2),
        rules.Rule("lookup", sql="t.v = l.code", alias="l", order=2),
        rules.Rule("element", "V", "upper(t.v)", order=1),
    ]
    out = rules.apply_rules(df, steps, {"l": look}, "t", distinct=True, names={"v": "value", "id": ""})
    assert out.columns == ["id", "value", "w"]
    assert {tuple(r) for r in out.collect()} == {(1, "X", "hit"), (2, "Y", None)}


def test_rule_class_falls_back_to_generic():
    classes = [rules.RuleClass("m", "f(<alias:$1>.<element_name:$2>)"), rules.RuleClass("m", "g(<element_name:$1>)", "s1")]
    rule = rules.Rule("element", "c", rule_class="m", source="s2", parameters="element_name:default,other")
    assert rules.expand(rule, classes, "t").sql == "f(t.other)"
    assert rules.expand(rules.Rule("element", "c", rule_class="m", source="s1"), classes, "t").sql == "g(c)"
    with pytest.raises(KeyError):
        rules.expand(rules.Rule("element", "c", rule_class="none"), classes, "t")


def test_date_based_lookup_rule_in_full_load(spark):
    df = spark.createDataFrame([(1, "2020-01-05")], "k int, d string").select("k", F.col("d").cast("date").alias("add_date"))
    look = spark.sql(
        "select * from values (1, 'old', date'2019-01-01', date'2020-01-01'), (1, 'new', date'2020-01-02', date'9999-12-31')"
        " as v(k, word, add_date, delete_date)"
    )
    steps = [
        rules.Rule("lookup", sql="t.k = l.k", alias="l", full_load_join="date_based"),
        rules.Rule("element", "word", "l.word"),
    ]
    assert rules.apply_rules(df, steps, {"l": look}, "t", mode="full").first()["word"] == "new"
    assert rules.apply_rules(df, steps, {"l": look}, "t", mode="active").count() == 2
