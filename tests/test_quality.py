from strata.operators import quality as Q


def test_rule_boundaries_and_null_passes(spark):
    df = spark.createDataFrame([
        (1, 13, 100.0, 0, "x" * 5),
        (2, 14, 101.0, 1, "x" * 6),
        (3, 50, 249.0, 99, None),
        (4, 51, 250.0, 100, "ok"),
        (4, None, None, None, "ok"),
    ], "id int, age int, height double, rating int, name string")
    rules = [Q.unique("pk", "id"), Q.between("age_14_50", "age", 14, 50),
             Q.strictly_between("height_100_250", "height", 100, 250),
             Q.between("rating_1_99", "rating", 1, 99), Q.max_length("name_5", "name", 5),
             Q.not_null("age_nn", "age")]
    rep = {r.rule: r.violations for r in Q.violation_report(df, rules).collect()}
    assert rep == {"pk": 2, "age_14_50": 2, "height_100_250": 2, "rating_1_99": 2,
                   "name_5": 1, "age_nn": 1}
    valid, bad = Q.check_constraints(df, rules)
    assert [r.id for r in valid.collect()] == [3]
    failed = {r.id: set(r.failed_rules) for r in bad.collect() if r.age is not None}
    assert failed[1] == {"age_14_50", "height_100_250", "rating_1_99"}
    assert failed[4] == {"pk", "age_14_50", "height_100_250", "rating_1_99"}


def test_presence_report_contains_and_empty(spark):
    listing = spark.createDataFrame([
        ("bronze/Transfermarkt/players.csv", 10), ("bronze/Transfermarkt/player_valuations.csv", 0),
    ], "rel_path string, length long")
    req = ["Transfermarkt/players.csv", "Transfermarkt/player_valuations.csv",
           "FIFA 23 Players/male_players.csv"]
    rep = {r.item: r for r in Q.presence_report(listing, req, "rel_path", "contains",
                                                 "length").collect()}
    assert rep["Transfermarkt/players.csv"].present
    assert rep["Transfermarkt/player_valuations.csv"].empty_matches == 1
    assert not rep["FIFA 23 Players/male_players.csv"].present


def test_unique_ignores_null_keys_like_sql(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (2, 5)], "k int, v int")
    rules = [Q.unique("k_unique", "k"), Q.not_null("k_not_null", "k")]
    rep = {r.rule: r.violations for r in Q.violation_report(df, rules).collect()}
    assert rep == {"k_unique": 2, "k_not_null": 2}
    _, bad = Q.check_constraints(df, [Q.unique("k_unique", "k")])
    assert sorted(r.v for r in bad.collect()) == [3, 4]


def test_presence_report_endswith_and_equals(spark):
    listing = spark.createDataFrame([("silver/players/part-0.parquet", "players", 5),
                                     ("silver/clubs/part-0.parquet", "clubs", 0)],
                                    "rel_path string, prefix string, length long")
    ends = {r.item: r.matches for r in Q.presence_report(
        listing, ["part-0.parquet", "x.parquet"], "rel_path", "endswith").collect()}
    assert ends == {"part-0.parquet": 2, "x.parquet": 0}
    eq = {r.item: (r.present, r.empty_matches) for r in Q.presence_report(
        listing, ["players", "clubs", "fifa_players"], "prefix", "equals", "length").collect()}
    assert eq == {"players": (True, 0), "clubs": (True, 1), "fifa_players": (False, 0)}


def test_violation_report_without_rules_is_empty(spark):
    out = Q.violation_report(spark.range(3), [], table="t")
    assert out.count() == 0 and out.columns == ["table_name", "rule", "violations"]
