"""F7 by the table of rules: two hundred invented agents, and the table itself."""

from daypulse import fixtures as fx
from daypulse.operators import agent_rules
from daypulse.operators.agents import parse_user_agents

#: (text, device, system, major version) and (text, browser) of invented agents.
PLATFORMS = [
    ("(iPhone; CPU iPhone OS 15_4 like Mac OS X) AppleWebKit/605.1.15", "iPhone", "iOS", "15"),
    ("(iPad; CPU OS 9_3 like Mac OS X) AppleWebKit/605.1.15", "iPad", "iOS", "9"),
    ("(Linux; Android 11; Pixel 5) AppleWebKit/537.36", "Pixel 5", "Android", "11"),
    ("(Linux; Android 10; SM-A505FN Build/QP1A) AppleWebKit/537.36", "SM-A505FN", "Android", "10"),
    ("(Linux; U; Android 8.1.0; zh-CN; vivo X21 Build/OPM1; wv) AppleWebKit/537.36", "vivo X21", "Android", "8"),
    ("(Windows NT 10.0; Win64; x64) AppleWebKit/537.36", "Unknown device", "Windows", "10"),
    ("(Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15", "Mac", "Mac OS X", "10"),
    ("(X11; Linux x86_64) AppleWebKit/537.36", "Unknown device", "Linux", ""),
    ("(X11; CrOS x86_64 13904.97.0) AppleWebKit/537.36", "Unknown device", "Chrome OS", "13904"),
    ("(Linux; Tizen 5.5; SMART-TV) AppleWebKit/538.1", "Unknown device", "Tizen", "5"),
]
BROWSERS = [
    ("Chrome/99.0.4844 Safari/537.36", "Chrome"), ("Chrome/99.0 Safari/537.36 Edg/99.0", "Edge"), ("Chrome/64.0 Safari/537.36 Edge/17.17", "Edge"),
    ("Chrome/99.0 Safari/537.36 OPR/85.0", "Opera"), ("Version/15.4 Safari/604.1", "Safari"), ("CriOS/99.0 Mobile Safari/604.1", "Chrome Mobile iOS"),
    ("FxiOS/98.0 Mobile Safari/605.1", "Firefox iOS"), ("Chrome/99.0 MicroMessenger/8.0.20 NetType/WIFI Language/en", "WeChat"),
    ("Chrome/87.0 SamsungBrowser/14.0 Safari/537.36", "Samsung Internet"), ("Chrome/78.0 UCBrowser/13.3 Safari/537.36", "UC Browser"),
    ("Chrome/66.0 MQQBrowser/11.0 Safari/537.36", "QQ Browser"), ("Chrome/98.0 YaBrowser/22.3 Safari/537.36", "Yandex Browser"),
    ("Chrome/99.0 Safari/537.36 Vivaldi/4.3", "Vivaldi"), ("Gecko/20100101 Firefox/98.0", "Firefox"), ("Gecko/20100101 Firefox/98.0 SeaMonkey/2.53", "SeaMonkey"),
    ("HeadlessChrome/99.0 Safari/537.36", "HeadlessChrome"), ("Chrome/88.0 HuaweiBrowser/12.0 Safari/537.36", "Huawei Browser"),
    ("Chrome/99.0 DuckDuckGo/5 Safari/537.36", "DuckDuckGo"), ("DingTalk/6.5 Chrome/69.0", "DingTalk"), ("Chrome/80.0 MiuiBrowser/13.1 Safari/537.36", "MiuiBrowser"),
]


def parsed(spark, agents):
    df = spark.createDataFrame([(a,) for a in agents], "u_a string")
    rows = agent_rules.parse_distinct(df, agent_rules.default_rules(spark)).collect()
    return {r.u_a: (r.device, r.os, r.os_version, r.browser) for r in rows}


def test_two_hundred_agents(spark):
    want = {f"Mozilla/5.0 {p} {b}": (device, os, f"{os} {major}", browser)
            for p, device, os, major in PLATFORMS for b, browser in BROWSERS}
    assert len(want) == 200
    got = parsed(spark, want)
    assert {a: (got[a], w) for a, w in want.items() if got[a] != w} == {}


def test_odd_agents(spark):
    got = parsed(spark, [None, "", "   ", "curl", "xcurl/7", "CURL/8", "curl/8", "Mozilla", "漢字 Chrome/1", "$1 Android 4; $1)"])
    nothing = ("Unknown device", "Other", "Other ", "Other")
    for a in (None, "", "   ", "curl", "xcurl/7", "CURL/8", "Mozilla"):
        assert got[a] == nothing, a
    assert got["curl/8"][3] == "curl" and got["漢字 Chrome/1"][3] == "Chrome" and got["$1 Android 4; $1)"][0] == "$1"
    assert parsed(spark, []) == {}


def test_rows_keep_their_columns_and_copies(spark):
    rows = spark.createDataFrame([(1, "curl/7"), (2, "curl/7"), (3, None)], "id int, u_a string")
    got = agent_rules.parse_user_agents(rows, agent_rules.default_rules(spark))
    assert got.columns == ["id", "u_a", *agent_rules.FIELDS]
    assert sorted((r.id, r.browser) for r in got.collect()) == [(1, "curl"), (2, "curl"), (3, "Other")]


def test_agrees_with_the_rules_in_place_on_the_client_log(spark):
    rows = fx.client_log(spark.read.parquet("/root/testdata/sf0.001/events.parquet")).select("event_id", "u_a")
    a = parse_user_agents(rows).collect()
    b = agent_rules.parse_user_agents(rows, agent_rules.default_rules(spark)).select(*parse_user_agents(rows).columns).collect()
    assert sorted(a) == sorted(b)


def test_the_table_is_sound_and_only_candidates_are_matched(spark):
    rules = agent_rules.default_rules(spark)
    assert agent_rules.check_rules(rules).collect() == [] and rules.count() > 80
    broken = spark.createDataFrame([("os", 1, "Two words", "x", "y"), ("os", 5, "a", "x", "y"), ("os", 5, "b", "x", "y")], agent_rules.SCHEMA)
    assert agent_rules.check_rules(broken).count() == 3
    # a caller's own rules come first by priority; a thousand that share no word with an agent are never tried
    own = spark.createDataFrame([("browser", 1, "mytool", "MyTool/", "My Tool"), *[("browser", 1000 + n, f"word{n}", "(", "never")
                                                                                   for n in range(1000)]], agent_rules.SCHEMA)
    df = spark.createDataFrame([("MyTool/1 Chrome/99 Safari/1",)], "u_a string")
    assert agent_rules.parse_distinct(df, rules.unionByName(own)).first().browser == "My Tool"
