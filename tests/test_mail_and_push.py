import base64
import hashlib
import hmac
import json
from email.message import EmailMessage

from pyspark.sql import functions as F

from tributary.operators import mail, push
from tributary.plans import deployments, mailroom
from tributary.sources import readers

MAIL = "mail_id bigint, mailfrom string, rcptto array<string>, data string"
HEAD = "Subject: s\nDate: Mon, 01 Jan 2024 02:00:00 +0200\n"


def mails(spark, *listed):
    return spark.createDataFrame(
        [(i, "me@x", to, data) for i, (to, data) in enumerate(listed)], MAIL
    )


def rivers(spark):
    return spark.createDataFrame(
        [(1, 1, "one"), (2, 1, "two"), (3, 0, "off"), (4, 1, "one")],
        "id bigint, river_active int, email_id string",
    )


def drops_of(spark, *listed):
    drops, _, _ = mailroom.to_drops(mails(spark, *listed), rivers(spark))
    return {r["mail_id"]: r for r in drops.collect()}


def test_gates(spark):
    got = drops_of(
        spark,
        (["one@h", "two@h"], HEAD + "\na\nb"),
        (["off@h"], HEAD + "\nx"),
        (["one@h"], "Date: Mon, 01 Jan 2024 00:00:00 +0000\n\nno subject"),
        (["one@h"], HEAD + "\n"),
        (["nobody@h"], HEAD + "\nx"),
    )
    assert list(got) == [0]
    drop = got[0]
    assert drop["river_id"] == [1, 2, 4] and drop["droplet_content"] == "a<br>\nb"
    assert drop["droplet_date_pub"].timestamp() == 1704067200
    data = HEAD + "\na\nb"
    digest = hashlib.md5(f"me@x['one@h', 'two@h']{data}".encode()).hexdigest()
    assert drop["droplet_orig_id"] == digest and drop["media"] is None


def nested():
    message = EmailMessage()
    message["Subject"] = "s"
    message["Date"] = "Mon, 01 Jan 2024 00:00:00 +0000"
    message.set_content("héllo\n")
    message.add_alternative("<p>x</p>", subtype="html")
    message.add_attachment(b"\x00pdf", maintype="application", subtype="pdf")
    return message.as_string()


def test_nested_multipart_and_attachments(spark):
    parsed = mail.parse(mail.with_rivers(mails(spark, (["two@h"], nested())), rivers(spark)))
    drop = mail.to_drops(parsed, "store/").first()
    assert drop["droplet_content"].startswith("héllo<br>")
    digest = hashlib.sha256(b"\x00pdf").hexdigest()
    assert [tuple(m) for m in drop["media"]] == [("store/" + digest, "application", False)]
    stored = mail.attachment_store(mail.attachments(parsed)).collect()
    assert [(r["sha256"], bytes(r["payload"])) for r in stored] == [(digest, b"\x00pdf")]


def test_charsets_and_undecodable_mail(spark):
    latin = "Content-Type: text/plain; charset=iso-8859-1\nContent-Transfer-Encoding: base64\n\n"
    body = base64.b64encode("né".encode("latin-1")).decode()
    bad = "Content-Type: text/plain; charset=no-such-set\n\nx"
    drops, _, quarantine = mailroom.to_drops(
        mails(spark, (["two@h"], HEAD + latin + body), (["two@h"], HEAD + bad),
              (["two@h"], "Subject: s\n\nno date")),
        rivers(spark),
    )
    assert [r["droplet_content"] for r in drops.collect()] == ["né"]
    assert sorted(r["mail_id"] for r in quarantine.collect()) == [1, 2]


def test_comment_tokens(spark):
    tokens = spark.createDataFrame(
        [("T", "drop-comment", '{"drop_id":5,"context":"river","context_obj_id":6}'),
         ("B", "bucket-comment", '{"bucket_id":7}')],
        "token string, type string, data string",
    )
    sent = mails(
        spark, (["drop-comment-T@h"], "\nhi"), (["bucket-comment-T@h", "T@h"], "\nhi"),
        (["B@h", "T@h"], "\nhi"), (["x@h"], "\nhi"), (["T@h"], "\n"),
    )
    got = mailroom.to_comments(sent, tokens, "http://api/", "k").collect()
    hits = sorted((r["mail_id"], r["token"]) for r in got)
    assert hits == [(0, "T"), (1, "T"), (2, "B"), (2, "T")]
    urls = {r["token"]: r["post_url"] for r in got}
    assert urls["T"] == "http://api/drop/5/comment?api_key=k"
    assert urls["B"] == "http://api/bucket/7/comment?api_key=k"
    bodies = {r["token"]: json.loads(r["body"]) for r in got}
    assert bodies["T"] == {
        "comment_text": "hi", "from_email": "me@x", "context": "river",
        "context_obj_id": 6,
    }
    assert bodies["B"] == {"comment_text": "hi", "from_email": "me@x"}


def test_comments_are_retried_on_server_errors_only(spark):
    outbox = spark.createDataFrame(
        [(1, "a"), (2, "a"), (3, "a"), (4, "a")], "mail_id bigint, token string"
    )
    results = spark.createDataFrame(
        [(1, "a", 1, 500), (1, "a", 2, 200), (2, "a", 1, 503), (3, "a", 1, 404)],
        "mail_id bigint, token string, seq bigint, status int",
    )
    left = mail.to_retry(outbox, results)
    assert sorted(r["mail_id"] for r in left.collect()) == [2, 4]


def requests(spark, ids, bucket=1):
    rows = spark.createDataFrame(
        [(bucket, "http://d", "c", "k1", "web.bucket.push.site", i) for i in ids],
        "bucket_id bigint, post_url string, client_id string, client_secret string, "
        "routing_key string, id bigint",
    )
    return rows.withColumn("drop", F.struct("id"))


def test_payloads_are_signed_before_base64_and_bounded(spark):
    sent = deployments.outgoing(requests(spark, range(5)), "site").first()
    payload = json.dumps([{"id": i} for i in range(5)], separators=(",", ":"))
    assert sent["payload"] == payload
    assert sent["drops_b64"] == base64.b64encode(payload.encode()).decode()
    signed = hmac.new(b"k1", payload.encode(), hashlib.sha256).hexdigest()
    assert sent["checksum"] == signed and "client_secret" not in sent.asDict()
    parts = push.outbox(requests(spark, range(25)), most=80).collect()
    listed = [x["id"] for p in parts for x in json.loads(p["payload"])]
    assert len(parts) > 1 and sorted(listed) == list(range(25))
    assert deployments.outgoing(requests(spark, [1]), "other").isEmpty()


def test_messages_with_their_own_list(spark):
    message = spark.createDataFrame(
        [(1, "http://d", "c", "k1", [(3,), (1,)])],
        "bucket_id bigint, post_url string, client_id string, client_secret string, "
        "drops array<struct<id:bigint>>",
    )
    assert push.outbox_of_messages(message).first()["payload"] == '[{"id":3},{"id":1}]'
    assert [r["drop"]["id"] for r in push.drops_of(message).collect()] == [3, 1]


def test_log_and_pending(spark):
    log = spark.createDataFrame(
        [(1, 1, 0, None), (1, 2, 0, None), (2, 1, 0, None)],
        "bucket_id bigint, droplet_id bigint, droplet_push_status int, "
        "droplet_date_push string",
    )
    settings = spark.createDataFrame(
        [(1, 1), (2, 5), (3, -1)], "bucket_id bigint, pending_drop_count bigint"
    )
    pushed = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 9), (3, 1)], "bucket_id bigint, droplet_id bigint"
    )
    new_log, pending = deployments.delivered(log, settings, pushed, 1704067200)
    when = "2024-01-01 00:00:00"
    assert sorted(map(tuple, new_log.collect())) == [
        (1, 1, 1, when), (1, 2, 1, when), (2, 1, 0, None),
    ]
    assert sorted(map(tuple, pending.collect())) == [(1, 0), (2, 5), (3, -1)]
    again = push.update_log(new_log, pushed, 1704067200)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new_log.collect()))


def test_undelivered_payloads_stay(spark):
    sent = push.outbox(requests(spark, range(3)))
    ok = sent.select("bucket_id", "checksum", F.lit(200).alias("status"))
    assert push.undelivered(sent, ok).isEmpty()
    failed = ok.withColumn("status", F.lit(500))
    assert push.undelivered(sent, failed).count() == 1


def test_push_messages_may_carry_ids_as_text(spark, tmp_path):
    body = json.dumps(
        {"post_url": "http://d", "bucket_id": "7", "client_id": "c",
         "client_secret": "k1", "drops": [{"id": "3"}, {"id": 4}]}
    )
    spark.createDataFrame(
        [("web.bucket.push.site", "c", "r", 1, body)],
        "routing_key string, correlation_id string, reply_to string, "
        "seq bigint, body string",
    ).write.parquet(str(tmp_path / "requests"))
    rows = readers.push_requests(spark, str(tmp_path / "requests"))
    messages = push.wanted(push.parsed_messages(rows), "site")
    sent = push.outbox_of_messages(messages).first()
    assert sent["bucket_id"] == 7 and sent["payload"] == '[{"id":3},{"id":4}]'
