"""Topic queries as text: trees, errors, and rows against a plain evaluation."""

import itertools
import re

import pytest

from veracity.functions.topic import Node, TopicSyntaxError, parse, topic_query
from veracity.operators import prepare as P

# fixed value: the query of the scrape
SCRAPE = ('(Iran OR "Iranian" OR "IRGC" OR "Tehran" OR "Khamenei" OR "Strait of Hormuz" OR "US strikes" OR "airstrike" OR "Middle East war" OR "nuclear deal" '
          'OR "sanctions Iran" OR "Persian Gulf" OR "Houthis" OR "proxy war" OR "US military Iran" OR "Iran attack" OR "Iran missile" '
          'OR trump OR biden OR congress OR "white house" OR pentagon ) lang:en -is:retweet -is:reply')


def term(x):
    return Node("term", (x,))


def test_trees():
    a, b, c = term("a"), term("b"), term("c")
    assert parse("a b OR c") == Node("any", (Node("all", (a, b)), c))
    assert parse("a AND b OR c") == parse("(a b) OR c") == parse("a b OR c")
    assert parse("a (b OR c)") == Node("all", (a, Node("any", (b, c))))
    assert parse("-a") == parse("NOT a") == parse("-(a)") == Node("not", (a,))
    assert parse("--a") == parse("NOT NOT a") == a
    assert parse("a OR (b OR (c OR A))") == Node("any", (a, b, c))
    assert parse('"  two   Words "') == term("two words")
    assert parse("a-b") == term("a-b") and parse("or and") == Node("all", (term("or"), term("and")))
    assert parse("LANG:EN is:Reply") == Node("all", (Node("lang", ("en",)), Node("is", ("reply",))))
    whole = parse(SCRAPE)
    assert whole.kind == "all" and [p.kind for p in whole.parts] == ["any", "lang", "not", "not"] and len(whole.parts[0].parts) == 22


@pytest.mark.parametrize(("query", "at"), [("", 0), ("a OR", 4), ("(a", 2), ("a)", 1), ('a "b', 2), ("a OR OR b", 5), ('""', 1), ("has:links a", 0), ("NOT", 3), ("()", 1)])
def test_errors_say_where(query, at):
    with pytest.raises(TopicSyntaxError) as e:
        parse(query)
    assert e.value.at == at


def test_rows_match_a_plain_evaluation(spark):
    texts = [None, "", "Iran and the USA", "iranian", "the White  House", "white house staff", "a.pentagon!", "pentagons", "trumpet", "no TRUMP here", "proxy war_", "proxy war"]
    rows = list(itertools.product(texts, ("en", "EN", "de", None), (True, False, None), (False, True)))
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, text string, lang string, rt boolean, reply boolean")
    flags = {"retweet": "rt", "reply": "reply"}

    def has(text, *words):
        return any(re.search(rf"(?i)(?<!\w){re.escape(w)}(?!\w)", text or "") for w in words)
    cases = {
        SCRAPE: lambda t, g, rt, re_: has(t, "iran", "iranian", "trump", "white house", "pentagon", "proxy war") and (g or "").lower() == "en" and not rt and not re_,
        "iran OR -lang:en": lambda t, g, rt, re_: has(t, "iran") or (g or "").lower() != "en",
        "-(iran OR trump) is:reply": lambda t, g, rt, re_: not has(t, "iran", "trump") and bool(re_),
        '"white house" -staff OR the usa': lambda t, g, rt, re_: (has(t, "white house") and not has(t, "staff")) or (has(t, "the") and has(t, "usa")),
    }
    for query, plain in cases.items():
        got = {r.id for r in df.filter(topic_query(query, "text", "lang", flags)).collect()}
        assert got == {i for i, r in enumerate(rows) if plain(*r)}, query
    by_list = {r.id for r in P.topic_filter(df, "text", lang_col="lang", exclude_flags=["rt", "reply"]).collect()}
    assert by_list == {r.id for r in df.filter(topic_query(SCRAPE, "text", "lang", flags)).filter("lang = 'en'").collect()}


def test_terms_of_an_or_are_one_search_and_missing_columns_are_errors(spark):
    df = spark.createDataFrame([("x", "en")], "text string, lang string")
    plan = df.filter(topic_query("a OR b OR (c OR lang:en)", lang="lang"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1
    with pytest.raises(ValueError):
        topic_query("a lang:en")
    with pytest.raises(ValueError):
        topic_query("a is:reply", flags={"retweet": "rt"})
