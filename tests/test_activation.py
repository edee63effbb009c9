import json

from pyspark.sql import functions as F


from segmint.operators import activation as A


def queue_df(spark, rows):
    recs = []
    for i, (bucket, key) in enumerate(rows):
        body = {"source": A.EVENT_SOURCE, "detail-type": A.EVENT_DETAIL_TYPE,
                "detail": {"bucket": {"name": bucket}, "object": {"key": key, "size": 65}}}
        recs.append((str(i), json.dumps(body)))
    return spark.createDataFrame(recs, A.QUEUE_SCHEMA)


def catalogue(spark, names, ids):
    return spark.createDataFrame([(n, i, 1, p) for p, (n, i) in enumerate(zip(names, ids))],
                                 "name string, audience_id long, page long, position long")


def seg_catalogue(spark, names, ids):
    return spark.createDataFrame([(n, i, 0, p) for p, (n, i) in enumerate(zip(names, ids))],
                                 "name string, id long, page long, position long")


def test_fx4_fx9_fx10_routing(spark):
    b = "uploader-etl-artifacts-x"
    q = queue_df(spark, [
        (b, "output/file/test3/PHONE_SHA256/test4.gz"),
        (b, "output/file/test3/phone_sha256/test4.csv"),
        (b, "output/file/test3/type_3/x.csv"),
        (b, "output/test4.zip"),
        (b, "output/batch/my+segment/part1.csv.gz"),
        (b, "output/batch/my+segment/part1.csv"),
        ("test_bucket_name", "output/file/a/EMAIL_SHA256/x.csv"),
        (b, "transform_tmp/x.csv"),
    ])
    plan = A.plan_activation(A.parse_records(q), catalogue(spark, ["test3"], [77]),
                             seg_catalogue(spark, ["my segment"], [2]))
    got = {int(r.message_id): r for r in plan.collect()}
    assert set(got) == {0, 1, 2, 3, 4, 5}          # filtered: other bucket, tmp prefix
    assert (got[0].calculate_type, got[0].audience, got[0].action) == ("PHONE_SHA256", "test3", "APPEND")
    assert got[1].calculate_type == "PHONE_SHA256" and got[1].audience_id == 77
    assert got[2].reason == "UNSUPPORTED_TYPE"
    assert got[3].reason == "BAD_KEY"
    assert (got[4].audience, got[4].segment_id, got[4].action) == ("my segment", 2, "ADD_USERS")
    assert got[5].reason == "UNSUPPORTED_FILE"


def test_fx6_segment_lookup(spark):
    segs = seg_catalogue(spark, ["segment1", "segment2", "segment3"], [1, 2, 3])
    routed = spark.createDataFrame([("segment2",), ("segment",)], "audience string")
    got = {r.audience: r.segment_id for r in A.resolve_segment(routed, segs).collect()}
    assert got == {"segment2": 2, "segment": 0}


def test_fx7_audience_lookup_first_wins(spark):
    cat = catalogue(spark, ["1", "2", "3", "2"], [10, 20, 30, 99])
    routed = spark.createDataFrame([("1",), ("2",), ("3",), ("unknown",), ("",), (None,)],
                                   "audience string")
    got = [(r.audience, r.audience_id) for r in A.resolve_audience(routed, cat).collect()]
    assert sorted(got, key=str) == sorted([("1", 10), ("2", 20), ("3", 30), ("unknown", None),
                                          ("", None), (None, None)], key=str)


def test_fx11_status_messages(spark):
    b = "uploader-etl-artifacts-x"
    q = queue_df(spark, [(b, "output/file/known/EMAIL_SHA256/a.csv"),
                         (b, "output/file/new/EMAIL_SHA256/a.csv")])
    plan = A.plan_activation(A.parse_records(q), catalogue(spark, ["known"], [5]),
                             seg_catalogue(spark, [], []))
    msgs = {int(r.message_id): (r.status_code, r.message) for r in A.status_message(plan).collect()}
    assert msgs[0][0] == 200 and "successfully updated" in msgs[0][1]
    assert msgs[1][0] == 200 and "successfully created" in msgs[1][1]


def test_bad_json_body_goes_to_dead_letters(spark):
    good = json.dumps({"source": A.EVENT_SOURCE, "detail-type": A.EVENT_DETAIL_TYPE,
                       "detail": {"bucket": {"name": A.BUCKET_PREFIX}, "object": {"key": "output/file/a/EMAIL_SHA256/x"}}})
    q = spark.createDataFrame([("1", "{not json"), ("2", None), ("3", good), ("4", "[]")], A.QUEUE_SCHEMA)
    recs = A.parse_records(q)
    assert [int(r.message_id) for r in A.event_filter(recs).collect()] == [3]
    plan = {int(r.message_id): r for r in A.plan_activation(
        recs, catalogue(spark, [], []), seg_catalogue(spark, [], [])).collect()}
    assert {i: plan[i].reason for i in plan} == {1: "BAD_BODY", 2: "BAD_BODY", 3: None, 4: "BAD_BODY"}
    assert {int(r.message_id): r.status_code for r in A.status_message(
        A.plan_activation(recs, catalogue(spark, [], []), seg_catalogue(spark, [], []))).collect()} == {
        1: 400, 2: 400, 3: 200, 4: 400}


def test_event_rule_account_region_and_bucket(spark):
    def body(bucket, account, region):
        return json.dumps({"source": A.EVENT_SOURCE, "detail-type": A.EVENT_DETAIL_TYPE, "account": account,
                           "region": region, "detail": {"bucket": {"name": bucket}, "object": {"key": "output/x"}}})
    q = spark.createDataFrame([("1", body("mine-a", "1", "eu")), ("2", body("mine-b", "2", "eu")),
                               ("3", body("mine-c", "1", "us")), ("4", body(A.BUCKET_PREFIX, "1", "eu"))],
                              A.QUEUE_SCHEMA)
    recs = A.parse_records(q)
    ids = lambda rule: sorted(int(r.message_id) for r in A.event_filter(recs, rule).collect())
    assert ids(A.EventRule(bucket_prefix="mine")) == [1, 2, 3]
    assert ids(A.EventRule(bucket_prefix="mine", account="1")) == [1, 3]
    assert ids(A.EventRule(bucket_prefix="mine", account="1", region="eu")) == [1]
    assert ids(A.EventRule()) == [4]


def test_new_audience_is_created_once(spark):
    b = A.BUCKET_PREFIX
    q = queue_df(spark, [(b, "output/file/new/EMAIL_SHA256/a.csv"), (b, "output/file/new/PHONE_SHA256/b.csv"),
                         (b, "output/file/old/EMAIL_SHA256/c.csv"), (b, "output/file/new/type_3/d.csv")])
    args = (A.parse_records(q), catalogue(spark, [], []), seg_catalogue(spark, [], []))
    got = {int(r.message_id): r.action for r in A.plan_activation(*args).collect()}
    assert got == {0: "CREATE", 1: "APPEND", 2: "CREATE", 3: None}
    before = spark.createDataFrame([("new",)], "audience string")
    got = {int(r.message_id): r.action for r in A.plan_activation(*args, created=before).collect()}
    assert got == {0: "APPEND", 1: "APPEND", 2: "CREATE", 3: None}


def test_fx6_fx7_documents_through_the_catalogues(spark):
    """The documented responses: no page information, quoted ids."""
    seg = json.dumps({"request_status": "SUCCESS", "segments": [
        {"sub_request_status": "SUCCESS", "segment": {"id": i, "name": n}}
        for i, n in (("1", "segment1"), (2, "segment2"), ("x-3", "segment3"), (9, "segment2"))]})
    docs = spark.createDataFrame([(seg,)], "value string")
    routed = spark.createDataFrame([("segment1",), ("segment2",), ("segment3",), ("none",)], "audience string")
    got = {r.audience: r.segment_id for r in A.resolve_segment(routed, A.segment_catalogue(docs)).collect()}
    assert got == {"segment1": "1", "segment2": "2", "segment3": "x-3", "none": "0"}
    aud = json.dumps({"code": 0, "data": {"list": [{"name": "a", "audience_id": "22"}, {"name": "b", "audience_id": 23}]}})
    cat = A.audience_catalogue(spark.createDataFrame([(aud,)], "value string"))
    routed = spark.createDataFrame([("a",), ("b",), ("c",)], "audience string")
    got = {r.audience: r.audience_id for r in A.resolve_audience(routed, cat).collect()}
    assert got == {"a": "22", "b": "23", "c": None}


def test_supported_schemas_lists_absent_options(spark):
    from segmint.operators.payloads import supported_schemas
    parts = spark.createDataFrame(
        [("s", 0, "EMAIL_SHA256", "h1", 0), ("s", 0, "EMAIL_SHA256", "h2", 1),
         ("s", 0, "age", "35", 2), ("s", 1, "PHONE_SHA256", "h3", 3)],
        "segment_name string, chunk long, schema string, hash string, row_id long")
    got = sorted((r.chunk, r.send_order, r.schema, r.n_rows)
                 for r in supported_schemas(parts).collect())
    assert got == [(0, 1, "EMAIL_SHA256", 2), (0, 2, "MOBILE_AD_ID_SHA256", 0),
                   (0, 3, "PHONE_SHA256", 0), (1, 1, "EMAIL_SHA256", 0),
                   (1, 2, "MOBILE_AD_ID_SHA256", 0), (1, 3, "PHONE_SHA256", 1)]


def test_transform_keys_route_back(spark, tmp_path):
    """Object keys written by the transform parse back to audience and type."""
    from segmint.plans.registry import FILE_SPEC, audience_scan
    from segmint.plans.transform import transform_frame
    from tests.conftest import SF_SMALL
    keys = [r.object_key for r in transform_frame(audience_scan(spark, SF_SMALL, FILE_SPEC),
                                                   FILE_SPEC, cap_rows=30)
            .select("object_key").distinct().collect()]
    bucket = "uploader-etl-artifacts-x"
    q = queue_df(spark, [(bucket, k.replace(" ", "+")) for k in keys])
    plan = A.plan_activation(A.parse_records(q), catalogue(spark, [], []),
                             seg_catalogue(spark, [], [])).collect()
    assert len(plan) == len(keys) > 3
    assert all(r.reason is None and r.audience == FILE_SPEC.segment_name for r in plan)
    assert {r.calculate_type for r in plan} == set(FILE_SPEC.output_names)


def test_fx12_delivery_no_schemas_and_requests(spark):
    from segmint.operators.payloads import delivery_requests, delivery_status
    adds = spark.createDataFrame(
        [(1, "output/batch/s/a.csv.gz", "s", 2), (2, "output/batch/s/b.csv.gz", "s", 2)],
        "message_id long, key string, audience string, segment_id long")
    rows = spark.createDataFrame(
        [("output/batch/s/a.csv.gz", 0, "EMAIL_SHA256", "h1"),
         ("output/batch/s/a.csv.gz", 1, "EMAIL_SHA256", "h2, h3"),
         ("output/batch/s/a.csv.gz", 2, "PHONE_SHA256", "h4"),
         ("output/batch/s/b.csv.gz", 0, "age", "35")],
        "key string, row_id long, schema string, hash string")
    req = delivery_requests(adds, rows)
    bodies = {r.schema: (r.n_users, r.payload) for r in req.collect()}
    assert bodies["EMAIL_SHA256"] == (
        2, '{"users":[{"schema":["EMAIL_SHA256"],"data":[["h1"],["h2","h3"]]}]}')
    assert set(bodies) == {"EMAIL_SHA256", "PHONE_SHA256"}
    st = {int(r.message_id): r.response for r in delivery_status(adds, req).collect()}
    assert st[2] == "no schemas were found" and st[1] == "3 users in 2 requests"


def test_relative_key_decodes_uri(spark):
    from segmint.sources.audience import relative_key
    df = spark.createDataFrame(
        [("file:///base/dir/output/batch/Audience%207/x+y.csv.gz",)], "p string")
    got = df.select(relative_key(F.col("p"), "/base/dir").alias("k")).first().k
    assert got == "output/batch/Audience 7/x+y.csv.gz"


def test_undecodable_key_is_dead_lettered(spark):
    b = "uploader-etl-artifacts-x"
    q = queue_df(spark, [(b, "output/file/a%zz/EMAIL_SHA256/x.csv"),
                         (b, "output/file/caf%C3%A9/EMAIL_SHA256/x.csv")])
    plan = {int(r.message_id): r for r in A.plan_activation(
        A.parse_records(q), catalogue(spark, [], []), seg_catalogue(spark, [], [])).collect()}
    assert plan[0].reason == "UNDECODABLE_KEY" and plan[0].action is None
    assert plan[1].reason is None and plan[1].audience == "café"


def test_catalogue_pages_report_gaps_and_repeats(spark):
    def page(n, total, code=0, items=2):
        return (json.dumps({"code": code, "data": {"list": [{"name": f"a{n}{i}", "audience_id": str(i)} for i in range(items)],
                                                   "page_info": {"page": n, "total_page": total}}}),)
    docs = [page(1, 4), page(3, 4), page(3, 4), page(2, 4, code=1), page(4, 4, items=0), page(9, 4), ("{cut",)]
    got = {r.page: (r.status, r.n_documents, r.n_items) for r in A.catalogue_pages(
        spark.createDataFrame(docs, "value string")).collect()}
    assert got == {1: ("complete", 1, 2), 2: ("missing", 0, 0), 3: ("repeated", 2, 4), 4: ("complete", 1, 0),
                   9: ("unexpected", 1, 2)}
    # one response without page information is the whole catalogue; none at all has no pages
    one = [(json.dumps({"code": 0, "data": {"list": [{"name": "a", "audience_id": "1"}]}}),)]
    assert [tuple(r) for r in A.catalogue_pages(spark.createDataFrame(one, "value string")).collect()] == [(0, "complete", 1, 1)]
    assert A.catalogue_pages(spark.createDataFrame([], "value string")).count() == 0
