import base64
import struct

from ledgerlens.constants import SOL
from ledgerlens.plans.records import token_metrics, token_metrics_enriched
from ledgerlens.sources.enrichment import account_metadata, decimals_from_batches, decimals_from_responses, metadata_from_batches
from ledgerlens.sources.tables import derive_from_tpch, read_tables, write_tables


def _blob(name: bytes, symbol: bytes, uri: bytes, symbol_len=None) -> bytes:
    out = bytes(65)
    out += struct.pack("<I", len(name)) + name.ljust(32, b"\x00")
    out += struct.pack("<I", len(symbol) if symbol_len is None else symbol_len) + symbol.ljust(10, b"\x00")
    out += struct.pack("<I", len(uri)) + uri.ljust(200, b"\x00")
    return out


NONE = (None, None, None)


def b64(raw: bytes) -> str:
    return base64.b64encode(raw).decode()


def reply(blob: str) -> str:
    return '{"jsonrpc":"2.0","id":1,"result":{"value":{"data":["' + blob + '","base64"]}}}'


def test_account_metadata_cases(spark):
    """Each blob is made from known values; those are what must come out."""
    full = b64(_blob(b"Token One", b"ONE", b"https://m/1"))
    cases = {
        "ok": (full, ("ONE", "Token One", "https://m/1")),
        "bad_b64": ("!!!", NONE),
        "short": (b64(bytes(40)), NONE),
        "empty_symbol": (b64(_blob(b"Two", b"", b"https://m/2", symbol_len=0)), (None, "Two", "https://m/2")),
        "bad_utf8": (b64(_blob(b"\xffThree", b"THR", b"https://m/3")), ("THR", "Three", "https://m/3")),
        "replacement": (b64(_blob("a\ufffd\ufdd0b".encode() + b"\xfe", b"R", b"u")), ("R", "a\ufffd\ufdd0b", "u")),
        "stray": (full[:7] + " -\n" + full[7:], ("ONE", "Token One", "https://m/1")),
        "unpadded": (b64(bytes(67)).rstrip("="), NONE),
        "after_padding": (b64(_blob(b"N", b"S", b"U") + bytes(2)) + "AAAA", ("S", "N", "U")),
        "missing": (None, NONE),
    }
    df = spark.createDataFrame([(k, v[0]) for k, v in cases.items()], "mint string, account_data_b64 string")
    got = {r.mint: (r.symbol, r.name, r.uri) for r in account_metadata(df).collect()}
    assert got == {k: v[1] for k, v in cases.items()}
    # the same blobs inside whole replies
    df = spark.createDataFrame([(k, None if v[0] is None or "\n" in v[0] else reply(v[0])) for k, v in cases.items()]
                               + [("null", '{"result":{"value":null}}'), ("text", "no json")],
                               "mint string, response_json string")
    got = {r.mint: (r.symbol, r.name, r.uri) for r in account_metadata(df).collect()}
    assert got == {**{k: v[1] for k, v in cases.items()}, "stray": NONE, "null": NONE, "text": NONE}


def test_decimals_from_responses(spark):
    rows = [
        ("A", '{"result":{"value":{"data":{"parsed":{"info":{"decimals":9}}}}}}'),
        ("B", '{"result":{"value":null}}'),
        ("C", '{"result":{"value":{"data":["AA==","base64"]}}}'),
        ("D", "not json"),
        ("E", '{"error":{"code":-32600}}'),
        ("F", '{"result":{"value":{"data":{"parsed":{"info":{"decimals":99999999999}}}}}}'),
        ("G", '{"result":{"value":{"data":{"parsed":{"info":{"decimals":-1}}}}}}'),
        (SOL, '{"result":{"value":{"data":{"parsed":{"info":{"decimals":3}}}}}}'),
    ]
    df = spark.createDataFrame(rows, "mint string, response_json string")
    got = {r.mint: r.decimals for r in decimals_from_responses(df).collect()}
    assert got == {"A": 9, "B": 6, "C": 6, "D": 6, "E": 6, "F": 6, "G": 6, SOL: 9}


def test_repeated_replies_parsed_value_wins(spark):
    rows = [("A", "not json"), ("A", '{"result":{"value":{"data":{"parsed":{"info":{"decimals":2}}}}}}'),
            ("B", '{"result":{"value":null}}'), ("B", '{"result":{"value":null}}')]
    df = spark.createDataFrame(rows, "mint string, response_json string")
    got = sorted((r.mint, r.decimals) for r in decimals_from_responses(df).collect())
    assert got == [("A", 2), ("B", 6)]


def test_metadata_one_row_per_token(spark):
    from ledgerlens.sources.enrichment import metadata_per_token
    rows = [("A", None, None, None), ("A", "SYM", "Name", "u"), ("B", None, "n", None)]
    df = spark.createDataFrame(rows, "mint string, symbol string, name string, uri string")
    got = sorted(tuple(r) for r in metadata_per_token(df).collect())
    assert got == [("A", "SYM", "Name", "u"), ("B", None, "n", None)]


def test_out_of_range_decimals_are_unresolved(spark):
    from ledgerlens.operators.supply import resolved_decimals
    tokens = spark.createDataFrame([("A",), ("B",), ("C",)], "mint string")
    dec = spark.createDataFrame([("A", 99999999999), ("B", 255), ("C", -3)], "mint string, decimals long")
    got = {r.mint: r.decimals for r in resolved_decimals(tokens, dec).collect()}
    assert got == {"A": 6, "B": 255, "C": 6}


REQUESTS = "batch string, id bigint, mint string"


def parsed(i, d):
    return f'{{"jsonrpc":"2.0","id":{i},"result":{{"value":{{"data":{{"parsed":{{"info":{{"decimals":{d}}}}}}}}}}}}}'


def batch_decimals(spark, requests, bodies):
    got = decimals_from_batches(spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(bodies, "batch string, body string"))
    return {r.mint: r.decimals for r in got.collect()}


def test_batch_replies_match_by_id_in_any_order(spark):
    asked = [("a", i, f"m{i}") for i in range(1, 6)] + [("b", 1, "n1"), ("b", 2, SOL)]
    bodies = [("a", f"[{parsed(3, 3)}, {parsed(1, 1)},{parsed(99, 8)},\n{parsed(2, 2)}]"), ("b", f"[{parsed(2, 4)},{parsed(1, 7)}]")]
    assert batch_decimals(spark, asked, bodies) == {"m1": 1, "m2": 2, "m3": 3, "m4": 6, "m5": 6, "n1": 7, SOL: 9}


def test_batch_bodies_that_are_no_array_of_replies(spark):
    """A single reply is an array of one; broken, null, empty and absent bodies leave the defaults, odd elements cost no other."""
    asked = [(b, i, f"{b}{i}") for b in "abcdefgh" for i in (1, 2)]
    odd = '7, "x", null, [1], {"id":"1"}, {"id":1.5,"result":{}}, {"result":{}}, {"id":99999999999999999999}, {"id":2,"error":{"code":1}}'
    bodies = [("a", parsed(2, 0)), ("b", f"[{parsed(1, 3)},{parsed(2, 3)}"), ("c", None), ("d", ""), ("e", "[]"), ("f", "busy"),
              ("g", f"[{odd}, {parsed(1, 5)}]")]
    want = {f"{b}{i}": 6 for b in "abcdefgh" for i in (1, 2)} | {"a2": 0, "g1": 5}
    assert batch_decimals(spark, asked, bodies) == want


def test_later_batch_replies_replace_earlier_ones_and_failures_replace_none(spark):
    null = '{"id":1,"result":{"value":null}}'
    asked = [("a", 1, "x"), ("a", 2, "y"), ("a", 3, "y"), ("b", 1, "x"), (None, 1, "z"), ("c", None, "w")]
    bodies = [("a", f"[{parsed(1, 2)},{parsed(1, 4)},{null},{parsed(3, 8)},{parsed(2, 5)},{parsed(2, 300)}]"), ("b", f"[{null}]"),
              (None, f"[{parsed(1, 1)}]")]
    assert batch_decimals(spark, asked, bodies) == {"x": 4, "y": 5, "z": 6, "w": 6}


def test_metadata_batches_do_not_go_by_position(spark):
    def blob(name, symbol):
        return b64(_blob(name.encode(), symbol.encode(), b"https://m.example/1"))

    def reply(i, data):
        return f'{{"id":{i},"result":{{"value":{{"data":["{data}","base64"]}}}}}}'

    asked = spark.createDataFrame([("a", i, f"m{i}") for i in range(1, 5)], REQUESTS)
    body = f"[{reply(2, blob('Two', 'TW'))},{reply(7, blob('Seven', 'SE'))},{reply(1, blob('One', 'ON'))},{reply(3, '!!!')},{reply(3, blob('Three', 'TH'))}]"
    got = metadata_from_batches(asked, spark.createDataFrame([("a", body)], "batch string, body string")).collect()
    assert {r.mint: (r.symbol, r.name) for r in got} == {"m1": ("ON", "One"), "m2": ("TW", "Two"), "m3": ("TH", "Three"), "m4": (None, None)}


def test_batch_join_is_on_batch_and_id(spark):
    """No shuffle on the batch alone, and no row of the requests is lost on a large plan."""
    t = derive_from_tpch(spark, "/root/testdata/sf0.001")
    plan = decimals_from_batches(t.decimals_requests, t.decimals_batches)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "NestedLoop" not in plan
    assert decimals_from_batches(t.decimals_requests, t.decimals_batches).count() == t.decimals_requests.select("mint").distinct().count()


def test_enriched_run_from_batches_alone(spark, tmp_path):
    """Tables with batch replies only give the records that their decimals and metadata give as plain lookups."""
    t = derive_from_tpch(spark, "/root/testdata/sf0.001")
    only = t.with_(token_decimals=None, decimals_responses=None, metadata_accounts=None)
    write_tables(only, str(tmp_path))
    read = read_tables(spark, str(tmp_path), normalize_keys=False)
    want = token_metrics(t, decimals=decimals_from_batches(t.decimals_requests, t.decimals_batches),
                         metadata=metadata_from_batches(t.metadata_requests, t.metadata_batches))
    got = token_metrics_enriched(read)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.where("symbol is not null").count() > 0
