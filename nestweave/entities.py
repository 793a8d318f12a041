"""The two configurations of the one generic pipeline."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Entity:
    name: str
    id_column: str
    skip_landed: bool
    deduplicate: bool
    parallelism: int
    query_option: str | None
    sanitise_names: bool
    table_prefix: str
    column_format: str
    noop_table: str
    child_double_as_text: bool = True

    @property
    def base_table(self) -> str:
        return f"{self.table_prefix}rest_of_fields"

    def child_table(self, field: str) -> str:
        return f"{self.table_prefix}{field}"

    @property
    def noop_statement(self) -> str:
        return f"SELECT TOP(1) * FROM [dbo].[{self.noop_table}];"


# These must equal what consumers of the tables already expect.
CONVERSATIONS = Entity(
    name="conversations",
    id_column="id",
    skip_landed=True,
    deduplicate=True,
    parallelism=10,
    query_option="display_as=string",
    sanitise_names=True,
    table_prefix="conversation_history_",
    column_format="[%s] %s",
    noop_table="conversation_history_contacts",
)

TICKETS = Entity(
    name="tickets",
    id_column="__ticket_id__",
    skip_landed=False,
    deduplicate=False,
    parallelism=2,
    query_option=None,
    sanitise_names=False,
    table_prefix="intercom_tickets_",
    column_format="%s %s",
    noop_table="intercom_tickets_contacts",
)
