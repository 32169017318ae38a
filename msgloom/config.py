"""Fixed values and job settings.

Everything that names a vendor code, a status or a sender lives here, so that a job
for another account is a new settings object and no new code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

# --- fixed values: message events ------------------------------------------------
EVENT_NAMES = {
    "XsRJQh": "SMS Sent",
    "Y5SMsU": "SMS Failed",
    "Uv32rW": "SMS Clicked",
    "SGB8Vt": "SMS Received",
    "S5A6iQ": "SMS Unsubscribed",
    "SBXSA5": "SMS Relayed",
}
EVENT_STATUSES = {
    "SMS Sent": "SMS SEND",
    "SMS Received": "SMS DELIVERED",
    "SMS Relayed": "SMS RELAYED",
    "SMS Clicked": "SMS CLICKED",
    "SMS Failed": "SMS BOUNCE",
    "SMS Unsubscribed": "SMS UNSUBSCRIBE",
}
UNKNOWN_EVENT = "Unknown"
OTHER_STATUS = "OTHER"
CLICK_EVENT = "SMS Clicked"
INBOUND_EVENTS = ("SMS Sent", "SMS Unsubscribed")
FROM_NUMBER_CODES = ("XsRJQh", "S5A6iQ")
USAGE_CODES = ("SBXSA5",)
EXTRA_BODY_CODES = ("Y5SMsU", "SGB8Vt")
NO_BODY_CODES = ("Uv32rW", "SBXSA5")
CREDIT_PRICE = 0.09
EVENT_CHANNEL = "SMS"
EVENT_CAMPAIGN_TAGS = {
    "utm_source": "aff-cc",
    "utm_campaign": "R-CPL-001",
    "utm_medium": "affiliate",
}
EVENT_RENAMES = {
    "source_event_id": "source_id",
    "event_timestamp": "timestamp",
    "status_calc": "status",
    "campaign_name": "utm_term",
    "content_calc": "utm_content",
}

# --- fixed values: notifications ---------------------------------------------------
TEMPLATE_MARK = r"\{\{[^}]+\}\}"
SHORT_LINK = r"(bit\.ly|tinyurl|short|go\.|/aff_ad)"
DEFAULT_CAMPAIGN = "Unknown Campaign"
DEFAULT_AUDIENCE = "ALL_USERS"
NO_UNMAPPED = '{"no unmapped fields": null}'
NOTIFICATION_RENAMES = {
    "opt_id": "source_id",
    "message_type": "event_type",
    "send_date": "event_date",
    "send_datetime": "timestamp",
}

# --- fixed values: lead messages ---------------------------------------------------
SLOT_TITLES = {
    "weekdays_morning": "Weekdays - Morning",
    "weekdays_midday": "Weekdays - Midday",
    "weekdays_afternoon": "Weekdays - Afternoon",
    "weekdays_evening": "Weekdays - Evening",
    "saturday_morning": "Saturday - Morning",
    "saturday_midday": "Saturday - Midday",
    "saturday_afternoon": "Saturday - Afternoon",
    "saturday_evening": "Saturday - Evening",
    "sunday_morning": "Sunday - Morning",
    "sunday_midday": "Sunday - Midday",
    "sunday_afternoon": "Sunday - Afternoon",
    "sunday_evening": "Sunday - Evening",
}
SLOT_PHRASES = {
    "weekdays_morning": "weekday mornings (6am-10am)",
    "weekdays_midday": "weekday mid-days (10am-2pm)",
    "weekdays_afternoon": "weekday afternoons (2pm-6pm)",
    "weekdays_evening": "weekday evenings (6pm-9pm)",
    "saturday_morning": "Saturday mornings (6am-10am)",
    "saturday_midday": "Saturday mid-days (10am-2pm)",
    "saturday_afternoon": "Saturday afternoons (2pm-6pm)",
    "saturday_evening": "Saturday evenings (6pm-9pm)",
    "sunday_morning": "Sunday mornings (6am-10am)",
    "sunday_midday": "Sunday mid-days (10am-2pm)",
    "sunday_afternoon": "Sunday afternoons (2pm-6pm)",
    "sunday_evening": "Sunday evenings (6pm-9pm)",
}
SLOTS = tuple(SLOT_TITLES)
DEFAULT_SLOT_TITLE = "Weekdays - Afternoon"

# --- fixed values: landing ---------------------------------------------------------
HISTORICAL_START = "2024-01-01T00:00:00.000Z"
EVENT_PAGE = 100


@dataclass(frozen=True)
class Lineage:
    """Who a layer's rows come from; stamped on every row."""

    source: str
    connector_id: str
    user_id: str | None = None
    account_id: str | None = None
    profile_workspace_id: str | None = None


@dataclass(frozen=True)
class EventSettings:
    """Code lists and maps of the message-event job."""

    names: Mapping[str, str] = field(default_factory=lambda: dict(EVENT_NAMES))
    statuses: Mapping[str, str] = field(default_factory=lambda: dict(EVENT_STATUSES))
    click_event: str = CLICK_EVENT
    inbound_events: Sequence[str] = INBOUND_EVENTS
    from_number_codes: Sequence[str] = FROM_NUMBER_CODES
    usage_codes: Sequence[str] = USAGE_CODES
    extra_body_codes: Sequence[str] = EXTRA_BODY_CODES
    no_body_codes: Sequence[str] = NO_BODY_CODES
    credit_price: float = CREDIT_PRICE
    cost_type: str = "float"
    channel: str = EVENT_CHANNEL
    campaign_tags: Mapping[str, str] = field(default_factory=lambda: dict(EVENT_CAMPAIGN_TAGS))
    renames: Mapping[str, str] = field(default_factory=lambda: dict(EVENT_RENAMES))
    # Columns a first touch and a repeated id are looked up within; () means the whole range.
    day_columns: Sequence[str] = ("year", "month", "day")
    # Fields that the fixed schema does not know are kept, and reach ``unmapped``.
    keep_unknown: bool = False
