"""Lookups against brute force in Python on small tables."""

import random
import re

import pytest

from pintulog.operators import lookup
from pintulog.plans.institutions import NOISE, map_institution

DEFAULT = lookup.UNREGISTERED


def keys_frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


def names(spark, keys, hits, default=DEFAULT):
    frame = lookup.attach(keys_frame(spark, keys), "key", hits, "name", default)
    return {r.key: r.name for r in frame.collect()}


def random_table(seed, n):
    rng = random.Random(seed)
    word = lambda lo, hi: "".join(rng.choice("ab.@") for _ in range(rng.randint(lo, hi)))
    # A third of the rows share one pattern, as a hot key would.
    rows = [
        (
            None if rng.random() < 0.1 else "aab" if rng.random() < 0.33 else word(1, 5),
            None if rng.random() < 0.1 else word(1, 4),
            f"inst {i}",
            rng.choice(["Provinsi", "Kabupaten", "Kota", None]),
        )
        for i in range(n)
    ]
    return rows, sorted({word(0, 9) for _ in range(120)} | {"aab", ""})


def brute_substring(rows, column, key):
    seen = {}
    for row in rows:
        if row[column] is not None:
            seen[row[column]] = row[2]
    return next((name for pattern, name in seen.items() if pattern in key), DEFAULT)


def brute_owner(rows, key):
    for row in rows:
        if row[0] == key:
            return row[2]
    return next((r[2] for r in rows if r[1] is not None and r[1] in key), None)


def brute_requester(rows, key):
    for row in rows:
        if row[0] == key:
            return row[2]
    hit = (r[2] for r in rows if r[0] is not None and (key in r[0] or r[0] in key))
    return next(hit, DEFAULT)


@pytest.mark.parametrize("seed", [1, 2])
def test_lookups_equal_brute_force(spark, mapping, seed):
    rows, keys = random_table(seed, 40)
    table, frame = mapping(*rows), keys_frame(spark, keys)
    for i, column in enumerate(["akun_nasional", "domain"]):
        got = names(spark, keys, lookup.substring_lookup(frame, table, column))
        assert got == {k: brute_substring(rows, i, k) for k in keys}
    got = names(spark, keys, lookup.owner_lookup(frame, table), None)
    assert got == {k: brute_owner(rows, k) for k in keys}
    got = names(spark, keys, lookup.requester_lookup(frame, table))
    assert got == {k: brute_requester(rows, k) for k in keys}


def test_order_decides_and_repeats_keep_first_place_last_name(spark, mapping):
    table = mapping(
        ("b", None, "first b", "Kota"), ("a", None, "an a", "Kota"), ("b", None, "last b", "Kota")
    )
    hits = lookup.substring_lookup(keys_frame(spark, ["xaby", "a", "z"]), table, "akun_nasional")
    assert names(spark, ["xaby", "a", "z"], hits) == {"xaby": "last b", "a": "an a", "z": DEFAULT}


def test_null_patterns_and_keys_never_match_and_null_names_stay(spark, mapping):
    table = mapping((None, None, "hole", "Kota"), ("nan", None, None, "Kota"))
    frame = keys_frame(spark, ["banana", "None", None])
    hits = lookup.substring_lookup(frame, table, "akun_nasional")
    assert names(spark, ["banana", "None", None], hits) == {
        "banana": None, "None": DEFAULT, None: DEFAULT,
    }


def test_an_empty_mapping_gives_the_default(spark, mapping):
    hits = lookup.substring_lookup(keys_frame(spark, ["a"]), mapping().limit(0), "domain")
    assert names(spark, ["a"], hits) == {"a": DEFAULT}


def test_short_keys_join_at_most_one_row_each(spark, mapping):
    table = mapping(*[(f"a.go.id.{i}", None, f"inst {i}", "Kota") for i in range(1000)])
    keys = ["", "a", ".", "g", "o", "go", "id", "a.", "1", "99"]
    patterns = lookup.first_rows(table, "akun_nasional")
    assert lookup.containing_hits(keys_frame(spark, keys), patterns).count() <= len(keys)


def test_an_index_grows_with_the_length_of_a_text(spark, mapping):
    rng = random.Random(8)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz .") for _ in range(20_000))
    table = mapping((long, None, "long", "Kota"), ("nothing", None, "short", "Kota"))
    patterns = lookup.first_rows(table, "akun_nasional")
    assert lookup.gram_index(patterns, "text", ["hit"]).count() <= (lookup.GRAM + 1) * (len(long) + 7)
    keys = [long[5:9], long[400:1400], long, long[100:300] + "~", "nothin", "othingx", "", "q", "~"]
    hits = lookup.requester_lookup(keys_frame(spark, keys), table)
    found = names(spark, keys, hits)
    assert found == {k: brute_requester([(long, None, "long", "Kota"), ("nothing", None, "short", "Kota")], k) for k in keys}


def test_a_very_long_key_is_looked_up(spark, mapping):
    long = "x" * 50_000 + "needle" + "y" * 100
    table = mapping(("needle", None, "found", "Kota"), *[("z" * n, None, "no", "Kota") for n in range(1, 41)])
    hits = lookup.substring_lookup(keys_frame(spark, [long, "é" * 300 + "needle"]), table, "akun_nasional")
    assert set(names(spark, [long, "é" * 300 + "needle"], hits).values()) == {"found"}


def test_lookup_plans_compare_no_pairs(spark, mapping):
    rows, keys = random_table(3, 20)
    hits = lookup.requester_lookup(keys_frame(spark, keys), mapping(*rows))
    hits.collect()
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def brute_institution(rows, provider, name):
    def first(test):
        return next((r[2] for r in rows if test(r)), DEFAULT)

    if provider is None:
        return None
    if "@" in provider:
        return first(lambda r: r[1] is not None and r[1] in provider)
    if provider != "admin":
        return first(lambda r: r[0] is not None and r[0] in provider)
    if name is None:
        return DEFAULT
    name = name.lower()
    kind, wanted = "other", None
    for word, of_type in (("prov", "Provinsi"), ("kab", "Kabupaten"), ("kota", "Kota")):
        if word in name:
            kind, wanted = word, of_type
            break
    needle = re.sub(NOISE[kind], "", name, flags=re.IGNORECASE).strip().replace(" ", "")
    texts = lambda r: [r[2] and r[2].lower().replace(" ", ""), r[0] and r[0].lower(), r[1] and r[1].lower()]
    return first(
        lambda r: any(t is not None and needle in t for t in texts(r))
        and (wanted is None or r[3] == wanted)
    )


def test_institution_routes_equal_brute_force(spark, mapping):
    rows = [
        ("jabar", "jabarprov.go.id", "Jawa Barat", "Provinsi"),
        ("bogor", "bogorkab.go.id", "Bogor", "Kabupaten"),
        ("bogor.kota", "kotabogor.go.id", "Kota Bogor", "Kota"),
        (None, "ja.go.id", "Jawa", "Provinsi"),
        ("JATIM", None, "Jawa Timur", "Provinsi"),
    ]
    apis = [
        (None, "x"), (None, None), ("u@jabarprov.go.id", "x"), ("u@none.id", None),
        ("admin", "SatuData Prov Jawa Barat"), ("admin", "data-prov"), ("admin", "OpenData_kab Bogor"),
        ("admin", " Portal Kota-Bogor "), ("admin", "data jawa"), ("admin", "prov kab kota Bogor"),
        ("admin", None), ("admin", "jatim-csw"), ("admin", "tab\tprov jawa"), ("x bogor y", None),
        ("Admin", "prov"), ("jabar", "y"), ("", "z"), ("admin", "-"), ("admin", "unknown thing"),
    ]
    frame = spark.createDataFrame(apis, "api_provider string, api_name string")
    result = map_institution(frame, mapping(*rows))
    got = {(r.api_provider, r.api_name): r.nama_instansi for r in result.collect()}
    assert result.columns == ["api_provider", "api_name", "nama_instansi"]
    assert got == {a: brute_institution(rows, *a) for a in apis}
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pieces_of_keys_are_cut_without_a_table_of_all_of_them(spark, mapping):
    """Keys are many, so nothing may gather their pieces; a text met twice in a key is one hit."""
    keys = spark.createDataFrame([("ab ab",), ("b" * 600 + "ab",), ("c",)], "key string")
    table = mapping(("ab", "ab", "Second", "Kota"), ("zz", "zz", "Other", "Kota"))
    cut = lookup.pieces(keys, "key", ["key"], lookup.lengths_of(table, "domain"))
    assert "Aggregate" not in cut._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
    hits = lookup.attach(keys, "key", lookup.substring_lookup(keys, table, "domain"), "name")
    assert sorted(tuple(r) for r in hits.collect()) == [("ab ab", "Second"), ("b" * 600 + "ab", "Second"), ("c", lookup.UNREGISTERED)]
