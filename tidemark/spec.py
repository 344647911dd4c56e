"""Names and rules that describe one historised entity."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# The accepted spellings of the two tracked columns.
DIVISIONS = ("North", "South", "East", "West", "Central")
AUDIT_PHASES = ("Phase1", "Phase2", "Phase3", "Complete")


@dataclass(frozen=True)
class HistorySpec:
    """Which column plays which part in a Type-2 history.

    key       natural key
    ts        modification time; orders the versions of a key
    tracked   a change in one of these opens a new version
    deleted   boolean delete marker
    required  columns that must be present in a stored version
    valid     column -> accepted values; versions outside are not stored
    """

    key: str
    ts: str
    tracked: tuple[str, ...]
    deleted: str = "is_deleted"
    required: tuple[str, ...] = ()
    valid: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    surrogate: str = "user_key"
    version_id: str = "_scd_id"
    stamp: str = "_dbt_updated_at"
    current: str = "is_current"
    sequence: str = "version_sequence"

    def order(self, columns: list[str]) -> list[str]:
        """A total order for the versions of one key.

        Time first; rows at the same time are told apart by the tracked columns,
        the delete marker and then whatever else the table carries, so that two
        runs over the same rows always agree.
        """
        head = [self.ts, *self.tracked, self.deleted]
        return head + sorted(c for c in columns if c not in head and c != self.key)


USERS = HistorySpec(
    key="user_id",
    ts="update_date",
    tracked=("division", "audit_phase__c"),
    required=("name",),
    valid={"division": DIVISIONS, "audit_phase__c": AUDIT_PHASES},
)

# The staged column names on the left, the dimension's names on the right.
USER_COLUMNS = {
    "id": "user_id",
    "isactive": "is_active",
    "lastmodifieddate": "update_date",
    "isdeleted": "is_deleted",
}
