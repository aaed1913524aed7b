import itertools

import pytest

from docloom.operators import patterns as p
from docloom.plans import dsl, views
from docloom.schemas import TRIPLE

XSD, LANG = "http://www.w3.org/2001/XMLSchema#", "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"
TRIPLES = [
    ("s1", "name", "Ann", XSD + "string", None, "g1"), ("s1", "knows", "s2", None, None, "g1"), ("s1", "knows", "s3", None, None, "g2"), ("s2", "name", "Bob", XSD + "string", None, "g1"),
    ("s2", "knows", "s1", None, None, "g2"), ("s3", "name", "s1", XSD + "string", None, "g1"), ("s3", "name", "Cy", LANG, "en", "g1"), ("s3", "age", "7", XSD + "integer", None, None),
    ("s1", "age", "7", XSD + "string", None, "g1"), ("s2", "likes", "s2", None, None, "g1"), ("s1", "name", "Ann", XSD + "string", None, "g2"), ("s4", "knows", "s4", None, None, "g1"),
]
V, I, L = p.Var, p.Iri, p.Literal


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(TRIPLES, TRIPLE)


def brute(patterns):
    """Solutions by trying all combinations of triples."""
    nodes = {t.name for q in patterns for place, t in q.terms() if place != "object" and isinstance(t, V)}
    out = set()
    for combination in itertools.product(TRIPLES, repeat=len(patterns)):
        got: dict = {}
        for q, t in zip(patterns, combination, strict=True):
            values = dict(zip(("subject", "predicate", "object", "datatype", "lang", "graph"), t, strict=True))
            for place, term in q.terms():
                if isinstance(term, V):
                    ok = values[place] is not None and got.setdefault(term.name, values[place]) == values[place] and not (place == "object" and term.name in nodes and values["datatype"])
                elif isinstance(term, L):
                    ok = values[place] == term.value and values["datatype"] and (not term.datatype or term.datatype == values["datatype"]) and (not term.lang or values["lang"] == term.lang)
                else:
                    ok = values[place] == term.value and (place != "object" or values["datatype"] is None)
                if not ok:
                    break
            else:
                continue
            break
        else:
            out.add(tuple(sorted(got.items())))
    return out


@pytest.mark.parametrize("patterns", [
    [p.Pattern(V("s"), I("name"), V("n"))],
    [p.Pattern(V("s"), I("knows"), V("o")), p.Pattern(V("o"), I("name"), V("n"))],
    [p.Pattern(V("a"), I("knows"), V("b")), p.Pattern(V("b"), I("knows"), V("a"))],
    [p.Pattern(V("x"), V("p"), V("x"))],
    [p.Pattern(V("s"), I("name"), V("n")), p.Pattern(V("n"), I("knows"), V("o"))],
    [p.Pattern(V("s"), I("age"), L("7", datatype=XSD + "integer"))],
    [p.Pattern(V("s"), V("p"), L("7")), p.Pattern(V("s"), I("name"), V("n"))],
    [p.Pattern(V("s"), I("name"), L("Cy", lang="en"))],
    [p.Pattern(V("s"), I("knows"), V("o"), V("g")), p.Pattern(V("s"), I("name"), V("n"), V("g"))],
    [p.Pattern(V("s"), I("knows"), I("s1")), p.Pattern(I("s1"), I("name"), L("Ann"))],
    [p.Pattern(V("s"), I("knows"), I("s1")), p.Pattern(I("s1"), I("name"), L("Zed"))],
    [p.Pattern(V("s"), I("knows"), V("o"), I("g2"))],
])
def test_against_all_combinations(rows, patterns):
    got = p.solutions(rows, patterns)
    assert {tuple(sorted(r.asDict().items())) for r in got.collect()} == brute(patterns) and got.distinct().count() == got.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan


def test_optional_graphs_and_repeats(rows):
    found = p.solutions(rows, [p.Pattern(V("s"), I("knows"), V("o"))], [[p.Pattern(V("o"), I("age"), V("age"))], [p.Pattern(V("o"), I("name"), V("n")), p.Pattern(V("o"), I("likes"), V("l"))]])
    assert sorted(map(tuple, found.select("s", "o", "age", "n", "l").collect())) == [("s1", "s2", None, "Bob", "s2"), ("s1", "s3", "7", None, None), ("s2", "s1", "7", None, None), ("s4", "s4", None, None, None)]
    assert p.solutions(rows, [p.Pattern(V("s"), I("name"), V("n"))], graphs=["g2"]).count() == 1
    assert p.solutions(rows, [p.Pattern(V("s"), I("name"), V("n"))], distinct=False).count() == 5


def test_the_telling_pattern_comes_first():
    wide, narrow, middle = p.Pattern(V("s"), V("p"), V("o")), p.Pattern(I("x"), I("q"), V("s")), p.Pattern(V("s"), I("q"), V("t"))
    assert p.ordered([wide, middle, narrow]) == [narrow, middle, wide]


def test_what_is_refused(rows):
    for patterns in ([], [p.Pattern(V("a"), I("name"), V("b")), p.Pattern(V("c"), I("name"), V("d"))], [p.Pattern(I("s1"), I("name"), L("Ann"))]):
        with pytest.raises(p.PatternError):
            p.solutions(rows, patterns).count()
    with pytest.raises(p.PatternError):
        p.solutions(rows, [p.Pattern(V("a"), I("name"), V("b"))], [[p.Pattern(V("c"), I("name"), V("d"))]])


def test_row_queries(spark, rows):
    build = dsl.Builder(views.Views(spark), triples=rows)
    q = "op.fromTriples([op.pattern(op.col('s'), sem.iri('knows'), op.col('o')), op.pattern(op.col('o'), sem.iri('name'), op.col('n')), op.optional([op.pattern(op.col('o'), sem.iri('likes'), op.col('l'))])], 't').where(op.ne(op.col('s'), 's2')).orderBy('n')"
    assert [tuple(r) for r in build.frame(q).select("`t.s`", "`t.n`", "`t.l`").collect()] == [("s1", "Bob", "s2"), ("s1", "Cy", None), ("s1", "s1", None)]
    assert build.frame("op.fromTriples(op.pattern(op.col('s'), 'age', 7))").count() == 2
    with pytest.raises(dsl.DslError):
        build.frame("op.fromTriples(op.pattern(op.col('s'), 'age'))")


def test_only_named_files_are_opened(spark, tmp_path):
    from docloom.sources import files

    for i in range(30):
        (tmp_path / f"f{i}.txt").write_text(f"text {i}")
    odd = tmp_path / "a [1]{b}*?.txt"
    odd.write_text("odd")
    rows_ = files.read(spark, str(tmp_path), {"streamFiles": "true"})
    wanted = rows_.filter("URI LIKE '%f7.txt' OR URI LIKE '%odd%' OR URI LIKE '%{b}%'")
    found = files.late(wanted)
    assert sorted(bytes(r["content"]).decode() for r in found.collect()) == ["odd", "text 7"]
    scan = found._jdf.queryExecution().analyzed().toString()
    assert len(found.inputFiles()) == 2, scan
