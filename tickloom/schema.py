"""Schemas and fixed values of the tick-by-tick message model."""

from __future__ import annotations

# --- fixed values of the wire format and of the data sets built from it ------
RECORD_BYTES = 72
BATCH_RECORDS = 1_000_000
NANOS = 1_000_000_000

# Exchange clock: nanoseconds since midnight 1980-01-01 in India (UTC+5:30).
SECONDS_1970_TO_1980 = 315_532_800
INDIA_OFFSET_SECONDS = 19_800
EXCHANGE_EPOCH_NS = (SECONDS_1970_TO_1980 - INDIA_OFFSET_SECONDS) * NANOS

ORDER_TYPES = ("N", "M", "X", "G", "H", "J")
TRADE_TYPES = ("T", "C", "K")
HEARTBEAT_TYPE = "Z"
KNOWN_TYPES = ORDER_TYPES + TRADE_TYPES + (HEARTBEAT_TYPE,)
MIN_MSG_LEN = {"order": 29, "trade": 36, "heartbeat": 4}

MAIN_TAPE_TYPES = ("N", "M", "X", "T")
AUX_TAPE_TYPES = ("G", "H", "J", "K")

FO_INSTRUMENTS = ("FUTSTK", "FUTIDX", "OPTSTK", "OPTIDX")
CM_INSTRUMENT = "EQUITY"
SHARED_SKIP_INSTRUMENTS = ("OPTSTK", "OPTIDX")
TEST_PREFIX = "TEST"
TOKEN_SLOTS = 1_000_000

FO_ARCHIVE_GLOB = "*.cap.tar.xz"
CM_ARCHIVE_GLOB = "*_166*.cap.tar.xz"
ARCHIVE_SUFFIXES = (".tar.xz", ".tar.gz", ".tar.bz2", ".tgz", ".cap")

BLANK_WORDS = ("", "na", "nan", "null")
ID_COLUMNS = ("order_id", "buy_order_id", "sell_order_id")
CORE_COLUMNS = (
    "capture_ns", "exchange_ns", "seq_no", "msg_type", "side",
    "order_id", "buy_order_id", "sell_order_id", "price", "quantity",
    "stream_id", "token",
)
OPTIONAL_CORE_COLUMNS = ("stream_id", "token")
COLUMN_ALIASES = {
    "capture_ns": ("capture_ns", "capturens", "capture_time_ns", "capture_timestamp_ns", "packet_capture_ns"),
    "exchange_ns": ("exchange_ns", "exchangens", "exchange_time_ns", "exchange_timestamp_ns", "exch_ns"),
    "seq_no": ("seq_no", "seqno", "sequence_no", "sequence_number", "packet_seq_no"),
    "msg_type": ("msg_type", "msgtype", "message_type", "type", "message"),
    "side": ("side", "order_side"),
    "order_id": ("order_id", "orderid"),
    "buy_order_id": ("buy_order_id", "buyorderid", "buy_id", "buyid"),
    "sell_order_id": ("sell_order_id", "sellorderid", "sell_id", "sellid"),
    "price": ("price", "order_price"),
    "quantity": ("quantity", "qty", "order_quantity"),
    "stream_id": ("stream_id", "streamid", "stream", "feed_id", "feedid", "channel_id", "channelid"),
    "token": ("token", "instrument_token", "instrumenttoken", "security_token", "securitytoken"),
}
# --- end of fixed values ------------------------------------------------------

# One capture record as typed lanes. Body lanes overlap on the wire, so which
# of them carries meaning depends on the message class.
LANES_DDL = (
    "archive_stem STRING, record_no BIGINT, cap_s BIGINT, pad0 BIGINT, "
    "cap_ns_part BIGINT, pad1 BIGINT, msg_len SMALLINT, stream_id SMALLINT, "
    "seq_no INT, msg_type_code SMALLINT, b0_i64 BIGINT, b8_f64 DOUBLE, "
    "b16_f64 DOUBLE, b0_i32 INT, b16_i32 INT, b20_u8 SMALLINT, b21_i32 INT, "
    "b24_i32 INT, b25_i32 INT, b28_i32 INT, b32_i32 INT"
)

MESSAGE_DDL = (
    "capture_ns BIGINT, exchange_ns BIGINT, stream_id SMALLINT, seq_no INT, "
    "msg_type STRING, token INT, side STRING, order_id DOUBLE, "
    "buy_order_id DOUBLE, sell_order_id DOUBLE, price INT, quantity INT"
)
MESSAGE_COLUMNS = tuple(field.split()[0] for field in MESSAGE_DDL.split(", "))
# Record number of the row that stands for a file that cannot be read.
UNREADABLE = -1
PROVENANCE_COLUMNS = ("archive_stem", "record_no")
