"""Mail text -> six string fields, as one projection over the raw mail.

Header and body are cut apart at the first blank line and every field is found by one anchored
regular expression. ``(?d)`` makes ``\\n`` the only line end (a ``\\r`` stays part of its line),
``(?s)`` lets ``.*`` run over lines so that the last header of a name wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Archive prefix, output delimiters, header names, date texts.
MAIL_PREFIX = "From dev-return"
FIELD_DELIMITER = "#|#"
RECORD_DELIMITER = "##//##"
HEADERS = {
    "subject": "subject: ",
    "sender": "from: ",
    "message_id": "message-id: ",
    "reply_to": "in-reply-to: ",
}
DATE_LENGTH = 24
READ_DATE = "MMM d H:m:s y"
WRITE_DATE = "yyyy-MM-dd-HH:mm:ss"
WEEKDAY = (
    "(?i)^(mon(day)?|tue(sday)?|wed(nesday)?|thu(rsday)?|fri(day)?|sat(urday)?|sun(day)?) "
)

# the newline before a line of characters up to U+0020; that line itself is not consumed
_BEFORE_BLANK_LINE = r"\n(?=[\x00-\x09\x0b-\x20]*(\n|\z))"
_HEADER_NAMES = "|".join(name[:-2] for name in HEADERS.values())
_DELIMITERS = "(" + "|".join((r"#\|#", "##//##")) + ")"
_DIRTY_HEADER = rf"(?dim)^({_HEADER_NAMES}): .*{_DELIMITERS}"
_SHORT_FIRST_LINE = rf"(?dm)^{MAIL_PREFIX}.{{0,{DATE_LENGTH - len(MAIL_PREFIX) - 1}}}$"


def contains_delimiter(text: Column) -> Column:
    return F.contains(text, F.lit(FIELD_DELIMITER)) | F.contains(text, F.lit(RECORD_DELIMITER))


def _last_line(header: Column, prefix: str, flags: str) -> Column:
    """The last header line with this prefix, prefix included; null when there is none."""
    pattern = rf"(?{flags})\A.*^({prefix}[^\n]*)"
    return F.nullif(F.regexp_extract(header, pattern, 1), F.lit(""))


def _header_value(header: Column, prefix: str) -> Column:
    return F.substring(_last_line(header, prefix, "dims"), len(prefix) + 1, 2**31 - 1)


def parse_mails(df: DataFrame, mode: str = "failfast", column: str = "value") -> DataFrame:
    """Mails with all mandatory fields and without output delimiters in any of them.

    Left out, as mails of no use: no message id, date line, sender, subject or body; a delimiter in
    a field; a date line too short to hold a date. A date line with an unreadable date is a
    malformed record: ``failfast`` fails the job, ``quarantine`` leaves the mail out (see
    :func:`undated_mails`).
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError("mode must be 'failfast' or 'quarantine'")
    sent = F.col("sent")
    if mode == "failfast":
        message = F.concat(F.lit("Unreadable mail date: "), F.col("date_line"))
        sent = F.when(_undated(), F.raise_error(message).cast("timestamp")).otherwise(sent)
    fields = _dated(_split_mail(df, column)).select(
        F.date_format(sent, WRITE_DATE).alias("time"),
        *(_header_value(F.col("header"), prefix).alias(name) for name, prefix in HEADERS.items()),
        F.replace(F.col("body"), F.lit("=\n"), F.lit("")).alias("body"),
        (F.col("too_short") | F.col("header").rlike(_DIRTY_HEADER)).alias("unwanted"),
    )
    usable = F.col("time").isNotNull() & ~F.col("unwanted")
    for name in ("message_id", "sender", "subject", "body"):
        usable = usable & F.col(name).isNotNull()
    usable = usable & ~contains_delimiter(F.col("body"))
    mail = F.struct(
        "message_id",
        "time",
        "sender",
        "subject",
        "body",
        F.coalesce("reply_to", F.lit("null")).alias("reply_to"),
    )
    # zero or one row per mail; a filter would be pushed down and run every expression twice
    return fields.select(F.inline(F.when(usable, F.array(mail))))


def undated_mails(df: DataFrame, column: str = "value") -> DataFrame:
    """The raw mails whose date line cannot be read."""
    return _dated(_split_mail(df, column)).filter(_undated()).select("value")


def _split_mail(df: DataFrame, column: str) -> DataFrame:
    """Header lines and body; the blank line between them belongs to the body.

    Newlines at the end of a mail do not make lines. The body is null if no blank line is left, and
    ends in a newline otherwise.
    """
    text = F.col(column).cast("string")
    mail = F.concat(F.lit("\n"), F.rtrim(text, F.lit("\n")))
    halves = df.select(
        text.alias("value"), F.split(mail, _BEFORE_BLANK_LINE, 2).alias("halves")
    )
    return halves.select(
        "value",
        F.get("halves", F.lit(0)).alias("header"),
        F.concat(F.get("halves", F.lit(1)), F.lit("\n")).alias("body"),
    )


def _dated(parts: DataFrame) -> DataFrame:
    """Find the date line and read the date in its last characters."""
    header = F.col("header")
    lines = parts.withColumns(
        {
            "date_line": _last_line(header, MAIL_PREFIX, "dms"),
            "too_short": header.rlike(_SHORT_FIRST_LINE),
        }
    )
    tails = lines.withColumn(
        "tail", F.regexp_replace(F.right("date_line", F.lit(DATE_LENGTH)), r"\s+", " ")
    )
    date = F.when(F.col("tail").rlike(WEEKDAY), F.regexp_replace("tail", WEEKDAY, ""))
    return tails.withColumn("sent", F.try_to_timestamp(date, F.lit(READ_DATE))).drop("tail")


def _undated() -> Column:
    return F.col("date_line").isNotNull() & ~F.col("too_short") & F.col("sent").isNull()


def mail_line() -> Column:
    """One output record: the six fields with the field delimiter between them."""
    names = ("message_id", "time", "sender", "subject", "body", "reply_to")
    parts = [F.col(names[0])]
    for name in names[1:]:
        parts += [F.lit(FIELD_DELIMITER), F.col(name)]
    return F.concat(*parts)
