from collections import Counter

from brute import blanks

from salesmart.llm import quality_rules as q


def base(text):
    text = text or ""
    w = blanks(text)
    lines = [x for x in text.split("\n") if blanks(x)]
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for k in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def kept(text):
    n, chars, symbols, dup, repeat = base(text)
    w, t = blanks(text), text or ""
    lines = [x for x in t.split("\n") if blanks(x)]
    stutter = sum(a == b for a, b in zip(w, w[1:]))
    return not (n < 10 or 5 * repeat > n or 10 * symbols > 3 * n or 2 * dup > len(lines) or not 2 * n <= chars <= 15 * n
                or 2 * t.count("!") > n or 10 * len(set(w)) < 3 * n or 10 * stutter > 3 * n)


TEXTS = ["", None, "one two", "a b c d e f g h i j", "word " * 40, "alpha beta gamma delta epsi zeta eta theta iota kappa lambda mu",
         "x\ny\nx\nx\n\n \nlong enough line of ten or more words is here now\n", "##a **b $$c %%d &&e ||f <<g >>h i j k l",
         "GO! NOW! RUN! STOP! WAIT! HEY! YOU! ALL! OF! IT! AND!", "aa aa bb bb cc cc dd dd ee ee ff ff gg gg", "é" * 400 + " b c d e f g h i j k",
         "p q r s t u p q r s t u v w x y z a b c d e f g h i j k l m n o", "1 2 3 4 5 6 7 8 9 0 " * 2 + " ".join(map(str, range(100, 400))),
         "\x0b\x0c\r\t tab\tseparated\x0bwords here are more than ten in this very line", " no break spaces are word characters here in this contract text ok"]


def test_against_plain_python(spark):
    docs = spark.createDataFrame([(i, t, "keep") for i, t in enumerate(TEXTS * 2)], "doc_id int, text string, Kept string")
    out, names = q.judge(docs)
    assert names["kept"] == "kept_"
    for r in out.collect():
        assert tuple(r[names[c]] for c in ("n_words", *q.BASE)) == base(r.text), r.text
        assert r[names["kept"]] == kept(r.text) and r.Kept == "keep"
        assert (r[names["failed_rule"]] is None) == r[names["kept"]]


def test_order_does_not_change_the_verdict(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    order = [rule for rule, _, _ in q.rule_order(docs)]
    assert sorted(order) == sorted(q.RULES)
    results = []
    for o in (order, order[::-1]):
        out, names = q.judge(docs, order=o)
        results.append({r.doc_id: r[names["kept"]] for r in out.collect()})
    assert results[0] == results[1] == {r.doc_id: kept(r.text) for r in docs.collect()}


def test_rules_are_ordered_by_rejection_per_cost(spark):
    found = q.rule_order(spark.createDataFrame([("##a **b $$c %%d &&e ||f <<g >>h i j k l",)] * 50, "text string"))
    assert found[0][0] == "symbols" and [x[2] / x[1] for x in found] == sorted((x[2] / x[1] for x in found), reverse=True)


def test_empty_table(spark):
    assert q.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0
