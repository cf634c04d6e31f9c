"""Readers and parsers: text/CSV files, Kafka, and the bundled test tables."""

from eventide.sources.files import (parse_access_log, parse_ad_click, parse_login,
                                    parse_order, parse_receipt, parse_user_behavior,
                                    read_lines)

__all__ = ["parse_access_log", "parse_ad_click", "parse_login", "parse_order",
           "parse_receipt", "parse_user_behavior", "read_lines"]
