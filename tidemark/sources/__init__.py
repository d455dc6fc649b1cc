from .delimited import (AD_CLICK, LOGIN_EVENT, MARKETING, ORDER_EVENT, PAY_EVENT, USER_BEHAVIOR,
                        parse_delimited, read_delimited)
from .kafka import decode_records, kafka_options, kafka_source
from .tables import TABLES, table

__all__ = ["AD_CLICK", "LOGIN_EVENT", "MARKETING", "ORDER_EVENT", "PAY_EVENT", "USER_BEHAVIOR",
           "parse_delimited", "read_delimited", "decode_records", "kafka_options", "kafka_source",
           "TABLES", "table"]
