import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.functions import tagged, urls
from viewloom.operators import network, quality
from viewloom.operators.quality import ListOf, MapOf, Scalar, Structure

URLS = [
    ("http://google.com/mail/", ("http", None, "google.com", None, "/mail/", None, None)),
    ("google.com:80", (None, None, "google.com", 80, None, None, None)),
    ("/foo?bar", (None, None, None, None, "/foo", "bar", None)),
    ("HTTP://User:p@ss@EXAMPLE.com:0080/A", ("http", "User:p%40ss", "example.com", 80, "/A", None, None)),
    ("http://example.com:/x", ("http", None, "example.com", None, "/x", None, None)),
    ("http://example.com:65536/", None),
    ("http://exa mple.com/%zz%20", ("http", None, "exa mple.com", None, "/%25zz%2520", None, None)),
    ("http://h/a/./b/../c/..", ("http", None, "h", None, "/a/", None, None)),
    ("http://h/../../a", ("http", None, "h", None, "/a", None, None)),
    ("http://h/%7efoo/ü?q=%c3%bc é#x y", ("http", None, "h", None, "/%7Efoo/%C3%BC", "q=%C3%BC%20%C3%A9", "x%20y")),
    ("http://[2001:DB8::1]:8080/p", ("http", None, "[2001:db8::1]", 8080, "/p", None, None)),
    ("http://127.0.0.1?x", ("http", None, "127.0.0.1", None, "", "x", None)),
    ("mailto:Joe%7e@X.org", ("mailto", None, None, None, "/Joe%7e@X.org", None, None)),
    ("http://h:abc/", None),
]


def test_parse_urls(spark):
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(URLS)], "i int, url string")
    got = {r.i: r.u for r in df.select("i", urls.parse_url(F.col("url")).alias("u")).collect()}
    for i, (url, expected) in enumerate(URLS):
        assert (None if got[i] is None else tuple(got[i])) == expected, url


def test_canonical_is_a_fixed_point(spark):
    df = spark.createDataFrame([(u,) for u, e in URLS if e and e[0] in ("http", "https")], "url string")
    once = df.select(urls.canonical_url(F.col("url")).alias("canonical"))
    twice = once.withColumn("again", urls.canonical_url(F.col("canonical")))
    assert twice.filter("not (canonical <=> again)").isEmpty()
    assert not once.filter("canonical is null").count()


def test_blocks(spark):
    df = spark.createDataFrame(
        [("192.168.1.1", "192.168.1.0/24"), ("192.168.1.1", "192.168.100.0/24"), ("10.0.0.1", "10.0.0.1/32"),
         ("255.255.255.255", "128.0.0.0/1"), ("1.2.3.4", "1.2.3.0/0"), ("1.2.3.256", "1.2.3.0/24"), ("1.2.3.4", "1.2.3.4")],
        "ip string, block string",
    )
    got = [r[0] for r in df.select(network.in_block(F.col("ip"), F.col("block"))).collect()]
    assert got == [True, False, True, True, None, None, None]


def test_longest_prefix_wins(spark):
    blocks = spark.createDataFrame(
        [("10.0.0.0/8", "wide"), ("10.1.0.0/16", "mid"), ("10.1.2.0/24", "b"), ("10.1.2.0/24", "a"), ("bad", "x")],
        "block string, label string",
    )
    df = spark.createDataFrame([("10.1.2.3",), ("10.1.9.9",), ("10.9.9.9",), ("11.0.0.1",), ("junk",), (None,)], "ip string")
    got = {r.ip: r.label for r in network.match_blocks(df, "ip", blocks).collect()}
    assert got == {"10.1.2.3": "b", "10.1.9.9": "mid", "10.9.9.9": "wide", "11.0.0.1": None, "junk": None, None: None}


SHAPE = Structure(
    {
        "id": Scalar("integer", min=1),
        "name": Scalar("string", min=2),
        "ratio": Scalar("double"),
        "at": Scalar("timestamp"),
        "rows": ListOf(Structure({"v": Scalar("boolean")}, required=("v",)), min=1),
        "tags": MapOf(Scalar("integer"), Scalar("string", min=2)),
        "one": Structure({"a": Scalar("string"), "b": Scalar("string")}, union=True),
    },
    required=("id", "name"),
)

RECORDS = [
    ('{"id":1,"name":"ab","ratio":2,"at":"2024-01-01","rows":[{"v":true}],"tags":{"xx":1},"one":{"a":"q"}}', []),
    ("{}", [("", "missing required field", "id"), ("", "missing required field", "name")]),
    ('{"id":0,"name":"a","zz":1}', [("", "unknown field", "zz"), (".id", "invalid range", "0"), (".name", "invalid length", '"a"')]),
    ('{"id":1.5,"name":null}', [(".id", "invalid type", "fraction"), (".name", "invalid type", "null")]),
    ('{"id":true,"name":"ab","rows":[]}', [(".rows", "invalid length", "0")]),
    ('{"id":1,"name":"ab","rows":[{"v":1},{},3]}',
     [(".rows[0].v", "invalid type", "integer"), (".rows[1]", "missing required field", "v"), (".rows[2]", "invalid type", "integer")]),
    ('{"id":1,"name":"ab","tags":{"x":"y"}}', [(".tags (key: x)", "invalid length", '"x"'), (".tags.x", "invalid type", "string")]),
    ('{"id":1,"name":"ab","one":{}}', [(".one", "empty input", None)]),
    ('{"id":1,"name":"ab","one":{"a":"1","b":"2"},"at":"soon"}', [(".at", "invalid type", "string"), (".one", "more than one input", None)]),
    ("[1]", [("", "invalid type", "array")]),
]


def test_all_violations_are_reported(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(RECORDS)], "i int, t string").withColumn("r", F.parse_json("t"))
    got = {}
    for r in quality.violation_rows(df, "r", SHAPE, ["i"]).collect():
        got.setdefault(r.i, []).append((r.path, r.reason, r.detail))
    for i, (text, expected) in enumerate(RECORDS):
        assert sorted(got.get(i, []), key=str) == sorted(expected, key=str), text
    report = quality.violation_report(quality.violation_rows(df, "r", SHAPE, ["i"]))
    assert (".rows[].v", "invalid type", 1) in rows(report)


def test_empty_list_is_not_ready(spark):
    df = spark.sql("select array() as e, array(true, true) as t, array(true, false) as m, cast(null as array<boolean>) as n")
    checks = [f(F.col(c), True) for f in (quality.path_all, quality.path_any) for c in "etmn"]
    assert tuple(df.select(*checks).first()) == (False, True, False, False, False, True, True, False)


TAGGED = [
    ('{"S":"a\\"b"}', '"a\\"b"'),
    ('{"N":"12.50"}', "12.50"),
    ('{"BOOL":false}', "false"),
    ('{"NULL":true}', "null"),
    ('{"SS":["a","b","a"]}', '["a","b"]'),
    ('{"NS":["1","2","1"]}', "[1,2]"),
    ('{"L":[{"N":"1"},{"L":[{"S":"x"}]}]}', '[1,["x"]]'),
    ('{"M":{"k":{"M":{"z":{"NULL":true}}}}}', '{"k":{"z":null}}'),
    ('{"N":"1e200"}', None),
    ('{"X":"1"}', None),
]


def test_untag(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TAGGED)], "i int, t string")
    got = {r[0]: r[1] for r in df.select("i", tagged.untag(F.parse_json("t"), 3)).collect()}
    for i, (text, expected) in enumerate(TAGGED):
        assert got[i] == expected, text


def test_untag_any_depth_and_dotted_names(spark):
    deep = '{"L":[{"L":[{"L":[{"M":{"a.b":{"L":[{"S":"x\\\\"}, {"L":[]}]}}}]}]}]}'
    df = spark.createDataFrame([(deep,), ('{"S":"[[{"}',)], "t string").select(F.parse_json("t").alias("t"))
    got = {r[0] for r in tagged.untag_column(df, "t", "plain").select("plain").collect()}
    assert got == {'[[[{"a.b":["x\\\\",[]]}]]]', '"[[{"'}
    with pytest.raises(Exception, match="deeper"):
        df.select(tagged.untag(F.col("t"), 1)).collect()
    names = spark.range(1).select(F.parse_json(F.lit('{"a.b":{"S":"1"},"it\'s":{"N":"2"}}')).alias("t"))
    row = names.select(tagged.attribute(F.col("t"), "a.b", "string").alias("x"), tagged.attribute(F.col("t"), "it's", "number_text").alias("y")).first()
    assert tuple(row) == ("1", "2")


@pytest.mark.parametrize(
    "host,expected",
    [
        ("[2001:DB8::1]", "[2001:db8::1]"),
        ("[::]", "[::]"),
        ("[1:2:3:4:5:6:7:8]", "[1:2:3:4:5:6:7:8]"),
        ("[::FFFF:1.2.3.4]", "[::ffff:1.2.3.4]"),
        ("[FE80::1%25Eth0]", "[fe80::1%Eth0]"),
        ("[FE80::1%Eth0]", "[fe80::1%Eth0]"),
        ("[:::::]", None),
        ("[1:2:3:4:5:6:7]", None),
        ("[1::2::3]", None),
        ("[1:2:3:4:5:6:7:8:9]", None),
        ("[12345::]", None),
        ("[1.2.3.4]", None),
        ("[::1%]", None),
        ("[::1", None),
    ],
)
def test_ipv6_hosts(spark, host, expected):
    got = spark.range(1).select(urls.parse_url(F.lit(f"http://{host}:80/")).alias("u")).first().u
    assert (got.host if got else None) == expected


@pytest.mark.parametrize(
    "text,fits",
    [("1" * 38, True), ("1" * 39, False), ("1" + "0" * 40, True), ("1e126", True), ("1e127", False),
     ("1e-128", True), ("1e-129", False), ("0.001e129", True), ("0e999", True), ("-0.5", True), ("NaN", False), ("", False)],
)
def test_number_range(spark, text, fits):
    got = spark.range(1).select(tagged.number_text(F.lit(text))).first()[0]
    assert (got == text) if fits else got is None


def test_tag_rows(spark):
    df = spark.sql(
        "select 'a\"b' as s, 5 as n, cast(1.50 as decimal(5,2)) as d, true as b, cast(null as string) as z, "
        "X'0102' as x, array('p', 'q', 'p') as st, map('k', 1) as m, named_struct('f', array(1, null)) as r"
    )
    item = tagged.tag_rows(df, sets=("st",)).first().item
    assert item == (
        '{"s":{"S":"a\\"b"},"n":{"N":"5"},"d":{"N":"1.50"},"b":{"BOOL":true},"z":{"NULL":true},"x":{"B":"AQI="},'
        '"st":{"SS":["p","q"]},"m":{"M":{"k":{"N":"1"}}},"r":{"M":{"f":{"L":[{"N":"5"},{"NULL":true}]}}}}'
    ).replace('[{"N":"5"}', '[{"N":"1"}')
    with pytest.raises(TypeError, match="decimal"):
        tagged.tag_rows(spark.sql("select 1.5D as f"))
    back = spark.createDataFrame([(item,)], "t string").select(F.parse_json("t").alias("i"))
    assert tuple(back.select(*[tagged.attribute(F.col("i"), c, k) for c, k in
                               (("s", "string"), ("n", "number"), ("b", "boolean"), ("z", "is_null"), ("st", "string_set"))]).first())[2:] == (True, True, ["p", "q"])


def test_documents_are_free_form(spark):
    shape = Structure({"d": quality.Document(), "n": Scalar("integer")}, required=("d",))
    rows_ = ['{"d":{"DATE":[1,"x",null,{"k":true}]},"n":1}', '{"d":null}', '{"d":[]}', '{"n":2}']
    df = spark.createDataFrame(list(enumerate(rows_)), "i int, t string").select("i", F.parse_json("t").alias("r"))
    got = [(r.i, r.reason) for r in quality.violation_rows(df, "r", shape, ["i"]).collect()]
    assert got == [(3, "missing required field")]
    typed = spark.range(1).select(F.to_variant_object(F.struct(F.current_date().alias("d"))).alias("r"))
    assert [r.reason for r in quality.violation_rows(typed, "r", shape, []).collect()] == ["invalid type for document"]


def test_the_type_of_a_holder_is_read_only_where_it_is_wrong(spark):
    """Naming a type reads the whole value."""
    df = spark.sql("""SELECT parse_json(j) AS v FROM VALUES ('{"a":[1]}'), ('[1]'), ('{"a":"x"}') AS t(j)""")
    shape = Structure({"a": ListOf(Scalar("integer"))})
    found = df.select(quality.violations(F.col("v"), shape).alias("f"))
    assert [[(x.path, x.reason, x.detail) for x in r.f] for r in found.collect()] == [[], [("", "invalid type", "array")], [(".a", "invalid type", "string")]]
    plan = found._jdf.queryExecution().analyzed().toString()
    # The one type that is named of every value is that of the list's members.
    assert plan.count("array(get(transform(array(schema_of_variant(") == 1
