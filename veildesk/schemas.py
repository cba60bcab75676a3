"""Record types of the helpdesk model, written out so no read has to infer them."""

from __future__ import annotations

# The enumerations a ticket update may use.
TICKET_STATUSES = ("new", "open", "pending", "hold", "solved", "closed")
TICKET_PRIORITIES = ("low", "normal", "high", "urgent")
TICKET_TYPES = ("problem", "incident", "question", "task")

# The ticket columns a macro may change.
MACRO_COLUMNS = (
    "subject",
    "priority",
    "type",
    "status",
    "custom_status_id",
    "assignee_id",
    "group_id",
    "tags",
    "custom_fields",
    "comment",
    "collaborator_ids",
    "follower_ids",
)

SPAN = "struct<start:int,end:int,type:string>"
SPANS = f"array<{SPAN}>"

CUSTOM_FIELD = "struct<id:bigint,value:string>"
ATTACHMENT = (
    "struct<id:bigint,file_name:string,content_url:string,content_type:string,size:bigint>"
)

USER = (
    "id bigint, name string, email string, phone string, role string, "
    "organization_id bigint, active boolean, created_at string"
)
TICKET = (
    "id bigint, subject string, description string, status string, priority string, "
    "type string, requester_id bigint, submitter_id bigint, assignee_id bigint, "
    "group_id bigint, organization_id bigint, created_at string, updated_at string, "
    f"tags array<string>, custom_fields array<{CUSTOM_FIELD}>"
)
COMMENT = (
    "id bigint, author_id bigint, public boolean, created_at string, body string, "
    f"plain_body string, html_body string, attachments array<{ATTACHMENT}>"
)

VAULT = "key string, type string, n bigint, placeholder string"


def struct_body(columns: str) -> str:
    """Turn ``a int, b array<..>`` (column DDL) into ``a:int, b:array<..>`` (struct DDL)."""
    out, depth, part = [], 0, ""
    for ch in columns + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            name, kind = part.split(None, 1)
            out.append(f"{name}: {kind.strip()}")
            part = ""
        else:
            part += ch
    return ", ".join(out)
