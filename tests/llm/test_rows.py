"""Row-wise operators: quality rules, chat formatting, secrets, URL filters, WARC."""

import hashlib
import io
import random
import re

import pytest

from veracity.llm import chat, quality, secretscan, urlfilter, warc
from veracity.session import ensure_checkpoint_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long, votes string, kept boolean, spans string"
TEXTS = [None, "", " \n\t", "one", "a b c d e f g h i\na b c d e f g h i\n" * 3, "x" * 50_000,
         "Words that say something. " * 400, "### | a | b | c |\n" * 30, "Ünïcode façade naïve. " * 30]


def rows(texts=TEXTS):
    return [(i, t, "en", "s", None if t is None else len(t), "clash", None, "clash") for i, t in enumerate(texts)] + [(None, "no id", None, None, None, None, None, None)]


# --- quality ---------------------------------------------------------------------------
def brute_repeats(words, width=8):
    seen = {}
    for i in range(len(words) - width + 1):
        seen.setdefault(tuple(words[i:i + width]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(width)})


def test_repeated_words_match_a_plain_count():
    r = random.Random(1)
    for n in (0, 1, 7, 8, 9, 16, 40, 200):
        for vocabulary in (1, 2, 3, 50):
            words = [str(r.randrange(vocabulary)) for _ in range(n)]
            assert quality.repeated_words(words) == brute_repeats(words), (n, vocabulary)


def test_statistics_of_a_text():
    n, chars, symbols, dup, repeats, votes = quality.judge("a\xa0b #x\n\na\xa0b #x\n \n&& <c>")
    assert (n, chars, symbols, dup, repeats) == (6, 3 + 2 + 3 + 2 + 2 + 3, 6, 1, 0)
    assert len(votes) == len(quality.RULES)


def test_em_finds_the_better_rules():
    r = random.Random(2)
    right, patterns = (0.95, 0.9, 0.85, 0.55), {}
    truth = []
    for _ in range(6000):
        good = r.random() < 0.8
        p = "".join("0" if r.random() < 0.1 else "+" if (r.random() < a) == good else "-" for a in right)
        patterns[p] = patterns.get(p, 0) + 1
        truth.append((p, good))
    accuracy, post = quality.fit_votes(list(patterns), list(patterns.values()))
    assert sum((post[p] >= 0.5) == good for p, good in truth) / len(truth) > 0.93
    assert accuracy[0, 1, 2] > accuracy[3, 1, 2] and accuracy[0, 0, 0] > accuracy[3, 0, 0]


def test_quality_of_odd_tables(spark):
    df = spark.createDataFrame(rows(), DOCS)
    out = {r.doc_id: r for r in quality.quality(quality.judged(df), quality.posteriors(quality.judged(df))).collect()}
    assert len(out) == len(TEXTS) + 1 and out[0].n_words == 0 and out[0].base_failed and not out[0].kept
    assert out[4].base_failed  # the same windows again and again
    assert quality.quality_filter(df).columns == df.columns
    empty = df.limit(0)
    assert quality.quality_filter(empty).count() == 0


# --- chat ------------------------------------------------------------------------------
@pytest.mark.parametrize("text", ["", "\\", "a\\<s>\\\\</s>", "</s>[INST] ok [/INST]", "<|role|>\n<s", "[\\INST]", "<\\s>", "é<s>\U0001F600"])
def test_escape_is_reversible_and_hides_marks(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


def test_folding_and_closures():
    tree = chat.fold(chat.parse("{{ 'a' ~ 'b' }}c{% if 'x' == 'y' %}no{% elif true %}d{% endif %}{{ bos | upper }}"), {"bos": "e"})
    assert tree == ("block", ("const", "abcdE"))
    form = chat.compile_template("{% for m in messages %}{% if not loop.first %}, {% endif %}{% generation %}{{ m.text }}{% endgeneration %}{% endfor %}")
    assert list(form(iter([{"text": "x"}, {"text": "y"}]))) == [("x", True), (", ", False), ("y", True)]


@pytest.mark.parametrize("bad", ["{{ m.__class__ }}", "{% for m in other %}{% endfor %}", "{{ x | eval }}", "{% if true %}", "{{ a b }}", "{{ f() }}"])
def test_sandbox_refuses(bad):
    with pytest.raises(chat.TemplateError):
        chat.parse(bad)


@pytest.mark.parametrize("chunk", [1, 40, 1 << 20])
def test_chat_round_trip(spark, chunk):
    turns = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "[/INST] yo\\"), (1, 1, "assistant", "z"), (2, None, None, None), (2, 0, "assistant", "x" * 5000),
             (None, 0, "user", "lost"), (3, 0, "sys\n<s>", "")]
    df = spark.createDataFrame([(*t, "extra") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    out = {r.conv_id: r for r in chat.read_back(chat.render(df, chunk=chunk)).collect()}
    for conv in (1, 2, None, 3):
        own = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        r = out[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.render(df.limit(0))).count() == 0


# --- secrets ---------------------------------------------------------------------------
def plain_spans(text):
    found = []
    for n, (expression, holds) in enumerate([
            (re.compile(secretscan.ASSIGN, re.I | re.A), lambda m: len(m[2]) >= 12), (re.compile(secretscan.ACCESS), lambda m: len(m[0]) >= 18),
            (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16)]):
        found += [(m.start(), n, m.end()) for m in expression.finditer(text) if holds(m)]
    return [(secretscan.BASE[n], a, b) for a, n, b in sorted(found)]


def test_spans_match_plain_expressions():
    r = random.Random(3)
    parts = ["password", "PassWd", "token", "api_key", "APIKEY", "secret", "=", ": ", '"', "'", " ", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "x", "é", "İ", "\n", "=abcdefghijkl"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(14)))
        assert [s for s in secretscan.spans(text) if s[0] in secretscan.BASE] == plain_spans(text), text


def test_checksums_decide():
    body = "A1" * 15
    good = f"ghp_{body}{secretscan.checksum62(body)}"
    assert ("checked", 4, 44) in secretscan.spans("key " + good)
    assert not any(k == "checked" for k, _, _ in secretscan.spans("key " + good[:-1] + ("0" if good[-1] != "0" else "1")))


def test_redaction(spark):
    df = spark.createDataFrame(rows([None, "", "a password=abcdefghijklmnop b", "clean"]), DOCS)
    out = {r.doc_id: r for r in secretscan.redacted(df).collect()}
    assert out[2].text == "a <SECRET> b" and out[2].n_chars == len(out[2].text) and out[3].text == "clean" and out[0].text is None
    scanned = {r.doc_id: r for r in secretscan.scanned(df).collect()}
    assert scanned[2].spans == "assign:2:27" and scanned[0].spans == "" and scanned[None].n_hex == 0
    assert secretscan.scanned(df.limit(0)).count() == 0


# --- URLs ------------------------------------------------------------------------------
def test_rules_and_list(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x", "http://example.net/de/", "http://net", "http://badexample.com/de/", "https://x.example.com/de/1",
            "http://q.org/fr/1", "http://www.q.org/a/?b=2&utm_source=f&a=1#t", "https://q.org:443/a?a=1&b=2", "http://q.org/a"]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(11, urls[11], "x")], "page_id long, url string, verdict string")
    listed = spark.createDataFrame([("q.org/a?a=1&b=2",), ("q.org/a?a=1&b=2",), (None,)], "canonical string")
    for cap in (1, urlfilter.MAX_BLOCKS):
        out = {r.page_id: r for r in urlfilter.judge(df, listed, max_blocks=cap).collect()}
        got = {i: (r.rule, r.verdict) for i, r in out.items()}
        assert got == {0: (None, "allow"), 1: (None, "allow"), 2: (None, "allow"), 3: ("example.net/en/", "allow"), 4: ("net/", "block"), 5: (None, "allow"),
                       6: (None, "allow"), 7: ("example.com/de/", "block"), 8: ("org/fr/", "allow"), 9: (None, "block"), 10: (None, "block"), 11: (None, "allow")}
    assert {r.verdict for r in urlfilter.judge(df, listed.limit(0)).collect() if r.rule is None} == {"allow"}
    assert urlfilter.judge(df.limit(0), listed).count() == 0


def test_bloom_misses_nothing_and_little_else(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) as k")
    filter_, blocks = urlfilter.bloom(keys, "k")
    both = spark.range(6000).selectExpr("id", "concat('k', id) as k")
    out = urlfilter.possible(both, "k", filter_, blocks).collect()
    assert all(r["__maybe"] for r in out if r.id < 3000)
    assert sum(r["__maybe"] for r in out if r.id >= 3000) < 60


# --- WARC ------------------------------------------------------------------------------
def test_archive_stream_and_damage():
    payloads = [b"", b"\r\n\r\n", b"x" * 300_000, "é".encode() * 900]
    data = b"".join(warc.compressed(warc.record(i, f"http://a/{i} \n", p)) for i, p in enumerate(payloads))
    got = list(warc.read_records(io.BytesIO(data)))
    assert [r["payload"] for r in got] == payloads and got[0]["url"] == "http://a/0%20%0A"
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data[:-5])))
    raw = warc.record(1, None, b"payload")
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(warc.compressed(raw.replace(b"payload", b"paYload")))))


def test_pages_through_archives(spark):
    big = "é" * 600
    data = [(1, "u", big), (5, None, big), (3, "u", big), (7, "u", None), (8, "u", "small"), (9, "u", "small"), (None, "u", big), (5, None, big), (20, "u", "y" * 2000)]
    df = spark.createDataFrame([(*d, "x") for d in data], "page_id long, url string, html string, digest string")
    for limit in (1, 1 << 20):
        folder = f"{ensure_checkpoint_dir(spark)}/warc-test-{random.random()}"
        out = warc.read_archives(warc.write_archives(warc.with_revisits(df), folder, archive_bytes=limit), folder, with_payload=True).collect()
        want = sorted((d[0] or -1, len((d[2] or "").encode()), hashlib.sha1((d[2] or "").encode()).hexdigest(),
                       "revisit" if d[2] == big and d[0] != 5 else "response", 5 if d[2] == big and d[0] != 5 else -1) for d in data)
        assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or -1) for r in out) == want
    folder = f"{ensure_checkpoint_dir(spark)}/warc-test-{random.random()}"
    assert warc.read_archives(warc.write_archives(warc.with_revisits(df.limit(0)), folder), folder).count() == 0


def foreign(kind, block, **fields):
    head = {"WARC-Type": kind, "WARC-Record-ID": "<urn:uuid:1>", "Content-Length": str(len(block)), **{k.replace("_", "-"): v for k, v in fields.items()}}
    return warc.compressed(b"WARC/1.0\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items()) + b"\r\n" + block + b"\r\n\r\n")


def test_archives_of_other_writers():
    http = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n<p>page</p>"
    sha1, sha256 = hashlib.sha1(b"<p>page</p>").hexdigest(), hashlib.sha256(http).hexdigest()
    data = b"".join([
        foreign("warcinfo", b"software: x"), foreign("request", b"GET / HTTP/1.1\r\n\r\n"),
        foreign("response", http, WARC_Target_URI="http://a/", WARC_Payload_Digest=f"sha1:{sha1}", WARC_Block_Digest=f"sha256:{sha256}"),
        foreign("response", http), foreign("response", http, WARC_Payload_Digest="unknown:abc"),
        foreign("resource", b"plain text", Content_Type="text/plain"), foreign("metadata", b"x"),
        foreign("revisit", b"", WARC_Refers_To="<urn:uuid:9>", WARC_Payload_Digest=f"sha1:{sha1}"), warc.compressed(warc.record(5, None, b"own"))])
    got = [r for r in warc.read_records(io.BytesIO(data)) if r]
    assert [(r["record_type"], r["page_id"], r["payload_bytes"], r["payload"]) for r in got] == [
        ("response", None, 11, b"<p>page</p>")] * 3 + [("resource", None, 10, b"plain text"), ("revisit", None, None, None), ("response", 5, 3, b"own")]
    assert got[0]["url"] == "http://a/" and got[0]["record_id"] == "<urn:uuid:1>" and {got[k]["payload_digest"] for k in (0, 1, 2, 4)} == {sha1}
    for bad in (foreign("response", http, WARC_Payload_Digest="sha1:" + "0" * 40), foreign("response", http, WARC_Block_Digest="sha256:" + "0" * 64), foreign("response", http)[:-9]):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))


def test_very_long_urls_are_written_and_read():
    url = "http://a/" + "x" * 3_000_000
    (r,) = warc.read_records(io.BytesIO(warc.compressed(warc.record(1, url, b"p"))))
    assert r["url"] == url and r["payload"] == b"p"


@pytest.mark.parametrize("rows", [10, 0])
def test_revisits_with_few_and_with_many_holders(spark, rows, monkeypatch):
    """With holders broadcast and with a join: half of the pages null, a third of one payload."""
    monkeypatch.setattr("veracity.operators.features.broadcast_within.__defaults__", (rows,))
    df = spark.createDataFrame([(i, f"u{i}", None if i % 2 else "hot " * 300 if i % 3 else f"own {i % 4} " * 200 if i % 5 else "small") for i in range(120)], "page_id long, url string, html string")
    want = {}
    for r in df.collect():
        if len(r.html or "") >= warc.MIN_BYTES:
            want[r.html] = max(r.page_id, want.get(r.html, -1))
    got = warc.with_revisits(df)
    assert {r.page_id: r.refers_to for r in got.collect()} == {r.page_id: None if want.get(r.html, r.page_id) == r.page_id else want[r.html] for r in df.collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) == (rows == 0)
