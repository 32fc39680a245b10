"""What the two feeds are expected to contain."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Feed:
    """Rules for one feed.

    `fields` maps each required key to the JSON types it may have, `optional` the
    same for keys that may be absent; `enums` lists the allowed texts of some
    keys; `key` holds the keys that identify a record when duplicates are removed.
    """

    name: str
    source: str
    fields: dict[str, tuple[str, ...]]
    enums: dict[str, tuple[str, ...]]
    key: tuple[str, ...]
    optional: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def types(self) -> dict[str, tuple[str, ...]]:
        """The JSON types of all declared keys."""
        return {**self.fields, **self.optional}


# Record ids are looked up under these keys, in this order.
ID_KEYS = ("event_id", "tx_id")

# Keys, types, allowed texts and labels of the two feeds.
CLIENT = Feed(
    name="client_events",
    source="client",
    fields={
        "event_id": ("str",),
        "timestamp": ("str",),
        "user_id": ("str",),
        "event_name": ("str",),
        "properties": ("dict",),
    },
    enums={
        "event_name": (
            "page_view",
            "add_to_cart",
            "purchase_intent",
            "purchase",
            "session_start",
            "checkout",
            "search",
        )
    },
    key=("user_id", "event_name", "timestamp"),
)

SERVER = Feed(
    name="server_logs",
    source="server",
    fields={
        "tx_id": ("str",),
        "timestamp": ("str",),
        "user_id": ("str",),
        "status": ("str",),
        "amount": ("int", "float"),
        "meta": ("dict",),
    },
    enums={"status": ("completed", "failed", "refunded", "pending")},
    key=("tx_id",),
)
