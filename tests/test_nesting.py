import json

from tarkaloom.operators.nesting import commentary_tree, record_table

RAW = "raw_id bigint, payload string, node_path string, open string"


def _unwrap(v):
    if isinstance(v, str) and v.lstrip()[:1] in ("{", "["):
        try:
            return json.loads(v)
        except ValueError:
            return v
    return v


def brute(raw_id, v, path, out):
    v = _unwrap(v)
    if isinstance(v, dict):
        for k, m in v.items():
            m = _unwrap(m)
            if k not in ("commentaries", "commentary"):
                brute(raw_id, m, path, out)
                continue
            for i, e in enumerate(m if isinstance(m, list) else [m]):
                e = _unwrap(e)
                if isinstance(e, dict):
                    p = f"{path}.{i}" if path else str(i)
                    c = _unwrap(e.get("commentator"))
                    name = c.get("name") if isinstance(c, dict) else c
                    school = e.get("school") or (c.get("school") if isinstance(c, dict) else None)
                    out.append((raw_id, p, path, name or "", school or ""))
                    brute(raw_id, e, p, out)
                else:
                    brute(raw_id, e, path, out)
    elif isinstance(v, list):
        for e in v:
            brute(raw_id, e, path, out)


def found(spark, payloads, **kw):
    df = spark.createDataFrame([(i, p, "clash", "clash") for i, p in enumerate(payloads)], RAW)
    return sorted((r.raw_id, r.node_path, r.parent_path, r.commentator, r.school) for r in commentary_tree(df, **kw).collect())


def wanted(payloads):
    out = []
    for i, p in enumerate(payloads):
        try:
            brute(i, json.loads(p), "", out)
        except (ValueError, TypeError):
            pass
    return sorted(out)


def deep(n):
    c = {"commentator": f"d{n}"}
    return {"commentaries": [None, c | ({"commentaries": json.dumps(deep(n - 1)["commentaries"])} if n % 2 and n > 0 else deep(n - 1) if n > 0 else {})]}


CASES = [
    json.dumps({"id": "a", "commentaries": [{"commentator": "x", "school": "s"}, None, 3, "plain", {"commentator": {"name": "y", "school": "t"}}]}),
    json.dumps({"record": {"commentary": {"commentator": {"name": "lone"}, "school": None, "replies": {"commentaries": [{"commentator": None}]}}}}),
    json.dumps([{"commentaries": json.dumps([{"commentator": "in a string"}])}, {"data": {"items": [{"commentaries": {"school": "q"}}]}}]),
    json.dumps({"commentaries": [[{"commentator": "in an inner array"}], "{\"commentator\": \"element string\"}"]}),
    json.dumps({"commentaries": []}),
    json.dumps({"commentaries": None}),
    '{"commentaries": [{"commentator": "cut',
    "",
    None,
    "null",
    "7",
    json.dumps(deep(9)),
]


def test_tree_equals_recursion(spark):
    assert found(spark, CASES) == wanted(CASES)


def test_no_depth_is_cut(spark):
    assert found(spark, CASES[-1:], levels=3) == wanted(CASES[-1:])


def test_empty_and_repeated(spark):
    assert found(spark, []) == []
    assert len(found(spark, [CASES[0], CASES[0]])) == 4


def test_records_keep_their_payload(spark):
    df = spark.createDataFrame([(1, json.dumps([{"id": "a"}, {"id": "b", "ref": {"chapter": 3}}])), (2, json.dumps({"record": {"id": "c"}})), (3, "x{")], "raw_id bigint, payload string")
    assert sorted((r.raw_id, r.rec_pos, r.id) for r in record_table(df).collect()) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]


def test_repeated_keys_and_white_space_before_nested_json(spark):
    cases = [
        '{"id": "a", "commentaries": [{"commentator": "x", "school": "s", "school": "t"}], "id": "b"}',
        '{"commentaries": [{"commentator": "lost"}], "commentaries": [{"commentator": "kept"}, {"commentator": "too"}]}',
        *[json.dumps({"commentaries": f"{ws}{json.dumps([{'commentator': 'in a string'}])}"}) for ws in ("\n", "\t", "\r\n ")],
        '\n\t{"commentaries": "{\\"commentator\\": 1, \\"commentator\\": \\"last\\"}"}',
    ]
    got = found(spark, cases)
    assert got == wanted(cases) and {r[0] for r in got} == set(range(6))
    assert [r.id for r in record_table(spark.createDataFrame([(1, cases[0])], "raw_id bigint, payload string")).collect()] == ["b"]


def test_every_commentary_knows_its_record(spark):
    one = lambda n: {"id": f"r{n}", "commentaries": [{"commentator": f"c{n}", "commentary": {"commentator": f"d{n}"}}]}
    payloads = [json.dumps([one(0), one(1), one(2)]), json.dumps({"data": {"items": [one(3), one(4)]}}), json.dumps({"record": one(5)}), json.dumps(one(6))]
    df = spark.createDataFrame([(i, p, "", "") for i, p in enumerate(payloads)], RAW)
    tree, records = commentary_tree(df), record_table(df)
    got = {(r.id, r.commentator) for r in records.join(tree, ["raw_id", "rec_pos"]).select("id", "commentator").collect()}
    assert got == {(f"r{n}", f"{x}{n}") for n in range(7) for x in "cd"}
    assert tree.count() == 14
