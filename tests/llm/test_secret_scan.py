import re

from millrace.llm import secret_scan as ss
from tests.llm.odd import ROWS, empty, frame

HEX = "0123456789abcdef" * 2
SECRETS = [
    (60, f'x password = "hunter2-long" y\nAPI_KEY:{HEX} AKIA{"A1" * 8} end'),
    (61, "Secret: abc token=abc apikey='abcdefgh' é漢 PASSWD:é passwd=123456"),
    (62, "token=token:abcdef token = token=abcdef"),
    (63, HEX + " " + HEX[:23] + " " + HEX[:24]),
    (64, f"AKIA{'B' * 15} AKIA{'B' * 16} xAKIAAKIA{'C' * 12}"),
    (65, "😀 secret=1234567 ghp_" + "a" * 36 + " xoxb-1234567890-ab"),
    (66, "-----BEGIN RSA PRIVATE KEY----- ftp://me:pw@host eyJabcdefgh.eyJabcdefgh.sig AIza" + "x" * 35 + " sk_live_" + "9" * 16),
    (67, f"{HEX} " * 300),
    (68, "tok en=abcdefg pass word:abcdefg"),
]
ALL = ROWS + SECRETS


def brute(text, rules=ss.RULES):
    out = []
    for rank, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), rank, r.kind, m.end()))
    return sorted(out)


def joined(spans, kinds=None):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans if kinds is None or k in kinds)


def test_spans_equal_brute_force(spark):
    out = ss.find_secrets(frame(spark, ALL))
    got = out.select("doc_id", ss.joined_spans(out["found"]), ss.joined_spans(out["found"], ["assign", "access", "hex"])).collect()
    want = [(i, joined(brute(t)), joined(brute(t), ("assign", "access", "hex"))) for i, t in ALL]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sum(len(brute(t)) for _, t in SECRETS) > 310


def test_trigram_queries_admit_every_match():
    for _, text in SECRETS:
        for r in ss.RULES:
            clauses = ss.trigram_query(r.pattern)
            for m in re.finditer(r.pattern, text, re.ASCII):
                assert clauses is None or any(all(t in m[0].lower() for t in c) for c in clauses)
    assert ss.trigram_query("[0-9a-f]+") is None
    assert ss.trigram_query("AKIA[A-Z]+") == [["aki", "kia"]]
    assert ss.trigram_query("(abc|defg)x?") == [["abc"], ["def", "efg"]]
    assert ss.trigram_query("(ab|cde)f*") is None


def test_only_candidates_are_verified(spark):
    rows = spark.createDataFrame([(1, 0, "a PassWord here"), (2, 0, "nothing"), (3, 0, "akia"), (4, 0, "pass swo word")], "doc long, tag long, text string")
    indexed = [r for r in ss.RULES if ss.trigram_query(r.pattern)]
    got = {r.doc: set(r.kinds) for r in ss.candidates(ss.postings(rows, indexed), indexed).collect()}
    assert got[1] == {"assign"} and got[3] == {"access"} and 2 not in got


def test_no_python_in_the_plan(spark):
    plan = ss.find_secrets(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|MapInArrow", plan)


def test_redaction(spark):
    out = ss.without_secrets(frame(spark, ALL))
    assert out.columns == frame(spark).columns
    for r in out.collect():
        text = next(t for i, t in ALL if i == r.doc_id and (t is None) == (r.text is None)) if r.doc_id is not None else r.text
        spans, at, want = brute(text), 0, ""
        for a, _, kind, b in spans:
            if a >= at:
                want += text[at:a] + f"[{kind}]"
            at = max(at, b)
        if text is not None:
            assert r.text == (want + text[at:] if spans else text)
            assert r.n_chars == len(r.text)
    assert ss.without_secrets(empty(spark)).collect() == []
