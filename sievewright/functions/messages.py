"""Conversations: arrays of (role, content) with content as text or as the JSON text of a block list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.functions.text import squeeze

BLOCKS = "array<struct<type:string,text:string,image:string,path:string,image_path:string,image_bytes_b64:string>>"

TURN = "struct<role:string,content:string>"
IMAGE_FIELDS = ("image", "path", "image_path", "image_bytes_b64")
#: Stands for a message that holds images only.
IMAGE_ONLY = "Image reference omitted for text-only training."

# Role names of other layouts, and older bucket names of categories.
ROLE_ALIASES = {"user": "user", "human": "user", "assistant": "assistant", "gpt": "assistant", "model": "assistant", "bot": "assistant"}
BUCKETS = {
    "identity": "identity_behavior", "general_polished": "polished_general_assistant", "real_user": "real_user_conversations",
    "multilingual": "multilingual", "utility": "utility_tasks",
}


def mapped(values: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[key]


def is_blocks(content: Column) -> Column:
    return content.startswith("[{") & F.from_json(content, BLOCKS).isNotNull()


def content_text(content: Column, joint: str = " ") -> Column:
    """Text of a message: itself, or its text blocks.  Only what starts like a block list is parsed, once."""
    texts = F.transform(F.filter(F.from_json(content, "array<struct<text:string>>"), lambda b: b["text"].isNotNull()), lambda b: b["text"])
    return F.coalesce(F.when(content.startswith("[{"), F.coalesce(F.array_join(texts, joint), content)).otherwise(content), F.lit(""))


def texts(messages: Column, role: str | None = None, joint: str = " ") -> Column:
    """Texts of all messages, or of those of one role."""
    kept = F.filter(messages, lambda m: m["role"] == role) if role else messages
    return F.transform(kept, lambda m: content_text(m["content"], joint))


def render_history(messages: Column) -> Column:
    """ROLE: text lines; a missing role is USER, empty texts are left out."""
    kept = F.filter(messages, lambda m: squeeze(content_text(m["content"])) != "")
    return F.array_join(
        F.transform(kept, lambda m: F.concat(F.upper(F.coalesce(m["role"], F.lit("user"))), F.lit(": "), squeeze(content_text(m["content"])))), "\n"
    )


def user_text(messages: Column) -> Column:
    return F.array_join(F.filter(F.transform(texts(messages, "user"), squeeze), lambda t: t != ""), "\n")


def last_assistant(messages: Column) -> Column:
    return F.try_element_at(texts(messages, "assistant"), F.lit(-1))


def has_image(messages: Column) -> Column:
    return F.coalesce(F.exists(messages, lambda m: is_blocks(m["content"]) & F.coalesce(F.exists(F.from_json(m["content"], BLOCKS), lambda b: b["type"] == "image"), F.lit(False))), F.lit(False))


def modality(declared: Column, messages: Column) -> Column:
    """image_text or text, as declared or else by the blocks."""
    said = F.lower(F.trim(declared))
    return F.when(said.isin("image_text", "multimodal"), "image_text").when(said == "text", "text").when(has_image(messages), "image_text").otherwise("text")


def category(name: Column, bucket: Column | None = None) -> Column:
    """The category, an older bucket's category, or unknown."""
    own = F.when(F.trim(name) != "", F.trim(name))
    old = F.trim(bucket) if bucket is not None else F.lit(None).cast("string")
    return F.coalesce(own, mapped(BUCKETS, old), F.when(old != "", old), F.lit("unknown"))


def role(name: Column) -> Column:
    """user or assistant, whatever the layout calls it; empty for others."""
    return F.coalesce(mapped(ROLE_ALIASES, F.lower(F.trim(name))), F.lit(""))


def image_kind(block: Column) -> Column:
    """How a block refers to its image, by priority."""
    held = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return (
        F.when(held(block["image_bytes_b64"]), "image_bytes_b64").when(held(block["image_path"]), "image_path")
        .when(held(block["image"]) & F.lower(F.trim(block["image"])).rlike("^(image|synthetic)://"), "placeholder_uri").when(held(block["image"]), "image_path_like").otherwise("missing")
    )


def chat_text(content: Column) -> Column:
    """A message as plain text: its text blocks, each trimmed, in lines; a fixed sentence for a list without text."""
    parts = F.filter(F.transform(F.filter(F.from_json(content, BLOCKS), lambda b: b["type"] == "text"), lambda b: F.trim(F.regexp_replace(b["text"], r"^\s+|\s+$", ""))), lambda t: t != "")
    listed = F.when(F.size(parts) > 0, F.array_join(parts, "\n")).otherwise(IMAGE_ONLY)
    return F.coalesce(F.when(is_blocks(content), listed).otherwise(F.regexp_replace(content, r"^\s+|\s+$", "")), F.lit(""))


def collapse_to_text(messages: Column) -> Column:
    """Messages as plain text, images dropped; a missing role is the user's."""
    return F.transform(messages, lambda m: F.struct(F.coalesce(F.nullif(m["role"], F.lit("")), F.lit("user")).alias("role"), chat_text(m["content"]).alias("content")))
