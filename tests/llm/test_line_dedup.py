from collections import Counter, defaultdict

from gridmix.llm import line_dedup, page_lines

BLANKS = " \t\r"


def model(rows, max_ratio, min_pages):
    pages, holds = Counter(), defaultdict(Counter)
    for host, text in rows:
        pages[host] += 1
        holds[host].update({x.strip(BLANKS) for x in (text or "").split("\n")} - {""})
    out = []
    for host, text in rows:
        if text is None:
            out.append((host, None, 0, 0))
            continue
        lines = text.split("\n")
        left = [x for x in lines if not (holds[host][x.strip(BLANKS)] >= min_pages
                                         and holds[host][x.strip(BLANKS)] > max_ratio * pages[host])
                or not x.strip(BLANKS)]
        out.append((host, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def test_equals_a_plain_version(spark):
    rows = [("a", f"Menu\n text {i}\n\n foot \nfoot") for i in range(30)]
    rows += [("a", f"own {i}\nseldom" if i < 3 else f"own {i}") for i in range(20)]
    rows += [("b", f"Menu\nb{i}") for i in range(4)] + [("c", "Menu")] * 9
    rows += [(None, "x\ny")] * 6 + [(None, None), ("a", None), ("a", ""), ("a", "\n\n"), ("a", "foot"),
                                    ("a", "long line " * 20000 + "\nMenu")]
    table = spark.createDataFrame([(h, t, 1, "keep") for h, t in rows],
                                  "source string, text string, n_lines int, extra string")
    for ratio, least in ((0.1, 5), (0.5, 2), (0.02, 1)):
        got = line_dedup.clean(table, max_ratio=ratio, min_pages=least)
        assert got.columns == ["source", "text", "extra", "n_lines", "n_dropped"]
        key = repr
        assert sorted(((r.source, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=key) == sorted(
            model(rows, ratio, least), key=key)


def test_empty_table_and_no_boilerplate(spark):
    table = spark.createDataFrame([], "source string, text string")
    assert line_dedup.clean(table).count() == 0
    one = spark.createDataFrame([("a", "x\ny")], "source string, text string")
    assert [(r.text, r.n_dropped) for r in line_dedup.clean(one).collect()] == [("x\ny", 0)]


def test_no_python(spark):
    table = spark.createDataFrame([("a", "x\ny")], "source string, text string")
    plan = line_dedup.clean(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pages_lose_the_lines_of_their_host(spark):
    page = ("<html><head><style>p{}</style><script>var t=\"</p>\";</script></head><body><nav><ul><li><a href='/x'>Home</a>"
            "</li></ul></nav><!-- ad --><p>own <b>text</b> %d &amp;amp;</p><footer>Imprint</footer></body></html>")
    rows = [(i, f"https://u@Blog.example.org:80/{i}?q#f", page % i) for i in range(30)]
    rows += [(30 + i, f"http://other.example.org/{i}", f"<p>Home</p><p>o{i}</p>" if i < 4 else f"<p>o{i}</p>")
             for i in range(40)]
    rows += [(100, None, "<p>Home"), (101, "https://blog.example.org/n", None)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.text, r.n_lines, r.n_dropped) for r in page_lines.clean(table).collect()}
    assert got[3] == ("blog.example.org", "own text 3 &amp;", 3, 2)
    assert got[30] == ("other.example.org", "Home\no0", 2, 0)  # on 4 pages of 40: fewer than 5
    assert got[100] == (None, "Home", 1, 0) and got[101] == ("blog.example.org", None, 0, 0)


def test_columns_named_like_its_own_are_kept(spark):
    rows = [(i, "h", "same\nown %d" % i, "d", "k", "o", "l", "p.q") for i in range(8)]
    pages = spark.createDataFrame(rows, "doc_id long, source string, text string, __DROP string, __kept string, "
                                        "__of string, __lines string, `a.b` string")
    got = line_dedup.clean(pages).collect()
    assert sorted((r.doc_id, r.text, r["__DROP"], r["__kept"], r["__of"], r["__lines"], r["a.b"]) for r in got) == [
        (i, "own %d" % i, "d", "k", "o", "l", "p.q") for i in range(8)]
