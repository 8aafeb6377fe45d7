"""Job configurations used by the registered queries, the bench and the
examples.  They are plain dicts, the same shape a YAML job file holds."""

from __future__ import annotations

# events rows as messages: the base columns, plus the integer k that sits in
# the JSON text of ``props`` (a temporary, read by a transform, then dropped).
EVENT_SCHEMA = {
    "event_id": {"path": "event_id", "type": "long"},
    "ts": {"path": "ts", "type": "timestamp_ntz"},
    "user_id": {"path": "user_id", "type": "long"},
    "event_type": {"path": "event_type", "type": "string"},
    "value": {"path": "value", "type": "double"},
    "props_txt": {"path": "props", "type": "string", "keep": False},
    "k": {"transform": "get_json_object(props_txt, '$.k')", "type": "int"},
    "value_k": {"transform": "value * k", "type": "double"},
}

EVENT_MODEL = {
    "type": "sklearn",
    "features": ["value", "k"],
    "name": "value_rule",
    "version": "v1",
}

# lineitem rows as messages: extraction plus derived pricing columns.
LINEITEM_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]

LINEITEM_SCHEMA = {
    "l_orderkey": {"path": "l_orderkey", "type": "long"},
    "l_linenumber": {"path": "l_linenumber", "type": "int"},
    "l_quantity": {"path": "l_quantity", "type": "double"},
    "l_extendedprice": {"path": "l_extendedprice", "type": "double"},
    "l_discount": {"path": "l_discount", "type": "double"},
    "l_tax": {"path": "l_tax", "type": "double"},
    "l_returnflag": {"path": "l_returnflag", "type": "string"},
    "l_linestatus": {"path": "l_linestatus", "type": "string", "keep": False},
    "disc_price": {"transform": "l_extendedprice * (1 - l_discount)", "type": "double"},
    "charge": {"transform": "disc_price * (1 + l_tax)", "type": "double"},
    "is_open": {"transform": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END", "type": "int"},
    "qty_int": {"transform": "l_quantity", "type": "int"},
}

# The older flat schema form ({column: type}) over events.
EVENT_FLAT_SCHEMA = {
    "event_id": "double",
    "k_text": "integer",
    "value": "double",
    "event_type": "string",
    "user_id": "double",
    "props": "no_such_type",
}
