import pytest
from pyspark.errors import PySparkException

from wayfare.functions.mail import parse_mails, undated_mails
from wayfare.operators.ordering import distinct_mails
from wayfare.sources.text import read_lines, read_mail_archive
from wayfare.streaming.jobs import mail_archive_to_text
from wayfare.streaming.sinks import write_mails

FIRST = "From dev-return-1-x@y Thu Jan 10 00:00:07 2013\n"
HEAD = "Message-ID: <m1>\nFrom: a <a@x>\nSubject: hello\n"


def only(df):
    (row,) = df.collect()
    return row


def test_fields(texts):
    mail = only(parse_mails(texts(FIRST + HEAD + "In-Reply-To: <m0>\n\nbody\n\n\n")))
    assert mail.asDict() == {
        "message_id": "<m1>",
        "time": "2013-01-10-00:00:07",
        "sender": "a <a@x>",
        "subject": "hello",
        "body": "\nbody\n",
        "reply_to": "<m0>",
    }


def test_reply_to_defaults_to_the_word_null(texts):
    assert only(parse_mails(texts(FIRST + HEAD + "\nx"))).reply_to == "null"


def test_header_names_ignore_case_and_the_last_one_wins(texts):
    raw = FIRST + HEAD + "SUBJECT: second\nsubject:third\n folded\nSubject: \nX-Subject: no\n\nx"
    assert only(parse_mails(texts(raw))).subject == ""
    raw = FIRST + HEAD + "SUBJECT: second\nsubject:third\n folded\n\nSubject: in the body"
    assert only(parse_mails(texts(raw))).subject == "second"


def test_soft_line_ends_are_joined(texts):
    raw = FIRST + HEAD + "\none=\ntwo==\nthree=\n=\nfour=\r\nfive="
    assert only(parse_mails(texts(raw))).body == "\nonetwo=threefour=\r\nfive"


def test_a_blank_line_of_control_characters_starts_the_body(texts):
    body = only(parse_mails(texts(FIRST + HEAD + " \t\r\nbody 🙂\n \n"))).body
    assert body == " \t\r\nbody 🙂\n \n"
    assert only(parse_mails(texts(FIRST + "X: 🙂🙂🙂\n" + HEAD + "\nb"))).body == "\nb\n"


def test_a_single_blank_end_line_with_spaces_is_a_body(texts):
    assert only(parse_mails(texts(FIRST + HEAD + "  \n\n"))).body == "  \n"


@pytest.mark.parametrize(
    "raw",
    [
        FIRST + HEAD,  # no body
        FIRST + HEAD + "\n\n\n",  # nothing but newlines after the header
        FIRST + HEAD.replace("Message-ID", "Id") + "\nx",
        FIRST + HEAD.replace("From", "Sender") + "\nx",
        FIRST + HEAD.replace("Subject: ", "Subject:") + "\nx",
        HEAD + "\nx",  # no date
        "From dev-return" + "\n" + HEAD + "\nx",
        "From dev-return-1234567\n" + HEAD + "\nx",  # 23 characters
        "From dev-return",
        "",
        "\n" + FIRST + HEAD + "\nx",  # all of it is body
        FIRST + "Subject: a#|#b\n" + HEAD + "\nx",  # dirty, though replaced later
        FIRST + HEAD + "in-reply-to: ##//##\n\nx",
        FIRST + HEAD.replace("<m1>", "<m#|#>") + "\nx",
        FIRST + HEAD.replace("a <a@x>", "##//##") + "\nx",
        FIRST + HEAD + "\nx#|#",
        FIRST + HEAD + "\nx##//=\n##y",  # a delimiter once lines are joined
    ],
)
def test_unusable_mails_are_left_out(texts, raw):
    assert parse_mails(texts(raw)).count() == 0


def test_very_long_headers_and_bodies(texts):
    long_header = FIRST + "X: " + "a #|# b: \t" * 200_000 + "\n" + "Y: z\n" * 100_000
    assert parse_mails(texts(long_header + HEAD)).count() == 0
    raw = long_header + HEAD + "\n" + "line =\n" * 200_000 + " " * 1_000_000
    body = only(parse_mails(texts(raw))).body
    assert body == "\n" + "line " * 200_000 + " " * 1_000_000 + "\n"


def test_delimiters_elsewhere_do_no_harm(texts):
    assert parse_mails(texts(FIRST + "X-Other: #|#\n" + HEAD + "\nx")).count() == 1


def test_unreadable_dates(texts):
    bad = [
        FIRST.replace("Thu", "Xyz") + HEAD + "\nx",
        FIRST.replace("Jan 10", "Foo 10") + HEAD + "\nx",
        FIRST.replace("10 00:00:07", "10 25:00:07") + HEAD + "\nx",
        # one day digit and one blank: the last 24 characters begin with a blank
        "From dev-return-1-x@y Thu Jan 3 00:00:07 2013\n" + HEAD + "\nx",
    ]
    padded = "From dev-return-1-x@y Thu Jan  3 00:00:07 2013\n" + HEAD + "\nx"
    assert only(parse_mails(texts(padded, *bad), "quarantine")).time == "2013-01-03-00:00:07"
    assert {r.value for r in undated_mails(texts(padded, *bad)).collect()} == set(bad)
    for raw in bad:
        with pytest.raises(PySparkException, match="Unreadable mail date"):
            parse_mails(texts(raw)).collect()


def mail(number, message_id, body="x"):
    head = HEAD.replace("<m1>", message_id)
    return FIRST.replace("00:07", f"00:{number:02d}") + head + f"\n{body}\n"


def test_first_mail_of_an_id_stays(texts):
    mails = parse_mails(texts(mail(5, "<a>"), mail(3, "<a>", "b"), mail(3, "<a>", "a"), mail(9, "<b>")))
    kept = {(r.message_id, r.time[-2:], r.body) for r in distinct_mails(mails).collect()}
    assert kept == {("<a>", "03", "\na\n"), ("<b>", "09", "\nx\n")}


def test_archive_is_cut_at_every_prefix(spark, tmp_path):
    archive = tmp_path / "archive"
    archive.mkdir()
    quoting = mail(1, "<a>", "before From dev-return-9 after")
    (archive / "one").write_text(quoting + mail(2, "<b>"))
    (archive / "two").write_text("From other@x\n" + HEAD + "\nx\n" + mail(3, "<c>"))
    raw = {r.value for r in read_mail_archive(spark, str(archive)).collect()}
    assert raw == {
        "From dev-return",
        mail(1, "<a>", "before ").rstrip("\n"),
        "From dev-return-9 after\n",
        mail(2, "<b>"),
        "From other@x\n" + HEAD + "\nx\n",
        mail(3, "<c>"),
    }
    parsed = parse_mails(read_mail_archive(spark, str(archive)))
    assert {r.message_id for r in parsed.collect()} == {"<a>", "<b>", "<c>"}


def test_archive_read_in_small_splits(spark, tmp_path):
    archive = tmp_path / "archive"
    archive.mkdir()
    (archive / "one").write_text("".join(mail(n % 60, f"<{n}>", "y" * n) for n in range(1, 300)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        raw = read_mail_archive(spark, str(archive))
        assert raw.rdd.getNumPartitions() > 20
        found = {r.message_id: len(r.body) for r in parse_mails(raw).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {f"<{n}>": n + 2 for n in range(1, 300)}


def test_job_writes_delimited_text_once(spark, tmp_path):
    archive, output = tmp_path / "archive", str(tmp_path / "out")
    archive.mkdir()
    (archive / "one").write_text(mail(1, "<a>", "l1\nl2") + mail(2, "<a>") + mail(3, "<b>"))
    mail_archive_to_text(spark, str(archive), output)
    lines = read_lines(spark, output, line_separator="##//##")
    assert {r.value for r in lines.collect()} == {
        "<a>#|#2013-01-10-00:00:01#|#a <a@x>#|#hello#|#\nl1\nl2\n#|#null",
        "<b>#|#2013-01-10-00:00:03#|#a <a@x>#|#hello#|#\nx\n#|#null",
    }
    with pytest.raises(PySparkException):
        write_mails(parse_mails(read_mail_archive(spark, str(archive))), output)
