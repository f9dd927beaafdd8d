"""What the edits of an editor add up to, as SQL aggregates over single edits.

Every measure is a count, a sum, a minimum or a maximum. Keeping features in this form
until the end is what allows one grouped pass for all of them. Conditions that are NULL
count as not holding.
"""

from __future__ import annotations

from holdfast.config import FeatureSpec
from holdfast.functions.scalars import DAY_SECONDS

HOURS_PER_DAY = 24


def gap_seconds(later: str, earlier: str) -> str:
    return f"(unix_timestamp({later}) - unix_timestamp({earlier}))"


def starts_session(spec: FeatureSpec) -> str:
    """An editor's first edit, or one after a gap strictly longer than allowed."""
    limit = spec.session_gap_minutes * 60
    return f"(prev_ts IS NULL OR {gap_seconds('ts', 'prev_ts')} > {limit})"


def returns_in_time(spec: FeatureSpec) -> str:
    """The window's last edit, if the next one is within the horizon (inclusive).

    Edits are ordered in time, so if any later edit is within the horizon, the next is.
    """
    horizon = spec.horizon_days * DAY_SECONDS
    return f"(edit_rank = {spec.window} AND {gap_seconds('next_ts', 'ts')} <= {horizon})"


def counts(spec: FeatureSpec) -> dict[str, str]:
    """Aggregates whose values for parts of an editor's edits are added up."""
    talk = ", ".join(str(n) for n in spec.talk_namespaces)
    diff = "revision_text_bytes_diff"
    return {
        "window_edits": "count(*)",
        "reverted": "count_if(revision_is_identity_reverted)",
        "reverted_known": "count(revision_is_identity_reverted)",
        "bytes_added": f"sum(if({diff} > 0, {diff}, 0L))",
        "bytes_removed": f"sum(if({diff} < 0, -{diff}, 0L))",
        "talk": f"count_if(page_namespace IN ({talk}))",
        "talk_known": "count(page_namespace)",
        "weekend": "count_if(dayofweek(ts) IN (1, 7))",
        "summarised": "count_if(event_comment <> '')",
        "minor": "count_if(revision_minor_edit)",
        "minor_known": "count(revision_minor_edit)",
        "sessions": f"count_if({starts_session(spec)})",
        "first_bytes": "sum(if(edit_rank = 1, revision_text_bytes, NULL))",
        "kept": f"count_if({returns_in_time(spec)})",
        **_hour_sums(spec),
    }


def _hour_layout(spec: FeatureSpec) -> tuple[int, int]:
    """Bits for one count of at most ``window`` edits, and how many fit in one bigint."""
    bits = spec.window.bit_length()
    return bits, 62 // bits


def _hour_sums(spec: FeatureSpec) -> dict[str, str]:
    """Edits per hour of the day, several small counts to one bigint.

    Counts side by side in one number add up independently, so two or three sums do the
    work of 24, in the shuffle-free groupings where every buffer counts.
    """
    bits, together = _hour_layout(spec)
    sums = {}
    for low in range(0, HOURS_PER_DAY, together):
        here = f"hour >= {low} AND hour < {low + together}"
        one = f"shiftleft(1L, (hour - {low}) * {bits})"
        sums[f"hours_from_{low}"] = f"sum(if({here}, {one}, 0L))"
    return sums


def _edits_in_hour(hour: int, spec: FeatureSpec) -> str:
    bits, together = _hour_layout(spec)
    low = hour // together * together
    return f"(shiftright(hours_from_{low}, {(hour - low) * bits}) & {2**bits - 1})"


def most_frequent_hour(spec: FeatureSpec) -> str:
    """The hour with the largest count, the earliest of them if several are equal.

    Count and hour make one integer, so the largest is found without sorting.
    """
    last = HOURS_PER_DAY - 1
    ranked = ", ".join(
        f"{_edits_in_hour(h, spec)} * {HOURS_PER_DAY} + {last - h}" for h in range(HOURS_PER_DAY)
    )
    return f"int({last} - greatest({ranked}) % {HOURS_PER_DAY})"
