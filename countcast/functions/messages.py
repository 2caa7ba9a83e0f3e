"""Building and reading the alert message text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the mail service.
TEMPLATE_ID = "10014"
MESSAGE_DDL = (
    "notification_id int, to array<string>, cc array<string>, template_id string, "
    "template_data struct<code:bigint,prediction:bigint,dCode:string,ruc:string,labels:string,data:string>, "
    "attachments array<string>"
)


def email_list(emails: Column) -> Column:
    """Pipe-separated addresses as a trimmed array; empty when there are none."""
    split = F.transform(F.split(emails, "[|]"), lambda e: F.trim(e))
    return F.when(emails.isNull() | (emails == ""), F.array().cast("array<string>")).otherwise(split)


def message_json(to: Column, code: Column, prediction: Column, name: Column, tax_id: Column,
                 labels: Column, data: Column) -> Column:
    """The message as JSON text; missing fields stay as nulls."""
    no_strings = F.array().cast("array<string>")
    body = F.struct(
        F.lit(0).alias("notification_id"),
        to.alias("to"),
        no_strings.alias("cc"),
        F.lit(TEMPLATE_ID).alias("template_id"),
        F.struct(
            code.alias("code"),
            prediction.alias("prediction"),
            name.alias("dCode"),
            tax_id.alias("ruc"),
            labels.alias("labels"),
            data.alias("data"),
        ).alias("template_data"),
        no_strings.alias("attachments"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def encode_message(json_text: Column) -> Column:
    """Base64 on a single line; Spark breaks lines after 76 characters."""
    return F.translate(F.base64(json_text.cast("binary")), "\r\n", "")


def decode_message(encoded: Column) -> Column:
    """Struct with the fields of an encoded message."""
    return F.from_json(F.unbase64(encoded).cast("string"), MESSAGE_DDL)
