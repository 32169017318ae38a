"""Message texts rendered as column expressions, one plan for a whole table of leads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgloom import config
from msgloom.functions.text import filled


def first_true_slot(
    flags: Mapping[str, Column],
    titles: Mapping[str, str] = config.SLOT_TITLES,
    default: str = config.DEFAULT_SLOT_TITLE,
) -> Column:
    """Title of the first set flag in the order of the titles, else the default."""
    picks = [F.when(flags[slot], F.lit(title)) for slot, title in titles.items() if slot in flags]
    return F.coalesce(*picks, F.lit(default))


def availability_sentence(
    flags: Mapping[str, Column], phrases: Mapping[str, str] = config.SLOT_PHRASES
) -> Column:
    """One sentence naming every set slot, joined by commas and a last "or"."""
    slots = F.array_compact(
        F.array(*[F.when(flags[s], F.lit(text)) for s, text in phrases.items() if s in flags])
    )
    count = F.size(slots)
    lead_in = F.lit("I've shared that you're available ")
    last = F.element_at(slots, -1)
    return (
        F.when(count == 0, F.lit("I've shared that your availability is flexible."))
        .when(count == 1, F.concat(lead_in, last, F.lit(".")))
        .otherwise(
            F.concat(
                lead_in,
                F.array_join(F.slice(slots, F.lit(1), count - 1), ", "),
                F.lit(" or "),
                last,
                F.lit("."),
            )
        )
    )


def greeting(name: Column, default: str) -> Column:
    """Greeting by name, or the template's own opening without one."""
    return F.when(filled(name), F.concat(F.lit("Hi "), name, F.lit(", "))).otherwise(F.lit(default))


def property_line(beds: Column, baths: Column) -> Column:
    """Property line, empty unless both counts are given."""
    return F.when(
        filled(beds) & filled(baths),
        F.format_string("\nProperty: %s Beds / %s Baths", beds, baths),
    ).otherwise(F.lit(""))


def appointment_text(
    name: Column,
    agent: Column,
    agent_phone: Column,
    address: Column,
    slot: Column,
    beds: Column,
    baths: Column,
) -> Column:
    """Message to consumer and agent that names the appointment."""
    return F.concat(
        greeting(name, "Hi, "),
        F.lit("congratulations.\nI'm connecting you with "),
        agent,
        F.lit(", who'll be helping you with your cash offer. His phone number is "),
        agent_phone,
        F.lit(".\n\n"),
        agent,
        F.lit(" will visit your property at "),
        address,
        F.lit(" on "),
        slot,
        F.lit(" and can often deliver an offer within 24 hours."),
        property_line(beds, baths),
    )


def introduction_text(
    name: Column, agent: Column, availability: Column, turnaround: str = "24 hours"
) -> Column:
    """Message to consumer and agent that repeats the consumer's availability."""
    return F.concat(
        greeting(name, ""),
        F.lit("Congratulations! I'm connecting you with "),
        agent,
        F.lit(", who'll be helping you with your cash offer. "),
        availability,
        F.lit("\n\n"),
        agent,
        F.lit(" is excited to get started and can often deliver an offer within "),
        F.lit(f"{turnaround}.\n\n"),
        F.lit('Please reply "Yes" to confirm you\'ve received this message.'),
    )


def agent_text(
    agent: Column,
    name: Column,
    address: Column,
    zip_code: Column,
    beds: Column,
    baths: Column,
    slot: Column,
) -> Column:
    """Note to the agent, addressed by first name."""
    return F.format_string(
        "Hi %s,\n\nYou've got a cash offer appointment scheduled with %s at %s, %s.\n\n"
        "Property: %s Beds / %s Baths\nAppointment Window: %s\n\n"
        "Please text the homeowner the time you will arrive and confirm. "
        "There's no need to ask for their availability — the appointment "
        "has already been set.",
        F.split_part(agent, F.lit(" "), F.lit(1)),
        name,
        address,
        zip_code,
        beds,
        baths,
        slot,
    )


def internal_text(
    name: Column,
    phone: Column,
    address: Column,
    zip_code: Column,
    agent: Column,
    agent_phone: Column,
    slot: Column,
) -> Column:
    """Note to the office."""
    return F.format_string(
        "New appointment confirmed.\n%s (%s)\n%s, %s\nAgent: %s \nPhone: (%s)\nTime: %s.",
        name,
        phone,
        address,
        zip_code,
        agent,
        agent_phone,
        slot,
    )


def friendly_name(name: Column, phone: Column, agent: Column) -> Column:
    """Conversation title; the phone stands in for a missing name."""
    person = F.coalesce(F.nullif(name, F.lit("")), phone)
    return F.concat(F.lit("Conversation between "), person, F.lit(" and "), agent)
