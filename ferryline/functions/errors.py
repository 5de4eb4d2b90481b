"""Error texts to classes, codes and severities; credentials out of URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that identify a class, tried in this order, with the status code of the class.
NOT_FOUND_TEXTS = ("NOT_FOUND", "no queue", "does not exist")
MISMATCH_TEXT = "PRECONDITION_FAILED"
MISMATCH_DETAIL_TEXT = "inequivalent arg"
CONNECTION_TEXTS = ("Channel closed", "Connection closed", "Channel closing")
MISMATCH_DETAIL = "Unable to retrieve stats due to declaration mismatch."
CREDENTIALS = "//.*@"
CREDENTIALS_MASK = "//***:***@"


def _mentions(message: Column, texts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for text in texts:
        found = found | message.contains(text)
    return found


def error_class(message: Column) -> Column:
    return (
        F.when(_mentions(message, NOT_FOUND_TEXTS), "QueueNotFoundError")
        .when(message.contains(MISMATCH_TEXT), "QueueConfigurationError")
        .when(_mentions(message, CONNECTION_TEXTS), "ConnectionError")
        .otherwise("RabbitMQError")
    )


def status_code(class_name: Column) -> Column:
    return (
        F.when(class_name == "QueueNotFoundError", 404)
        .when(class_name == "QueueConfigurationError", 409)
        .otherwise(503)
    )


def error_detail(message: Column, class_name: Column) -> Column:
    explained = (class_name == "QueueConfigurationError") & message.contains(MISMATCH_DETAIL_TEXT)
    return F.when(explained, MISMATCH_DETAIL).otherwise("")


def severity(code: Column, operational: Column) -> Column:
    return (
        F.when((code >= 500) | ~operational, "critical")
        .when(code >= 400, "client_error")
        .otherwise("info")
    )


def mask_credentials(url: Column) -> Column:
    """Hide what stands between ``//`` and the last ``@``."""
    return F.regexp_replace(url, CREDENTIALS, CREDENTIALS_MASK)
