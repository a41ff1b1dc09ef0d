"""Settings shared by every preparation step."""

from __future__ import annotations

from dataclasses import dataclass

# Option domains and defaults that decide results.
THINK_LOSS_MODES = ("all", "answer_only", "answer_plus_think")
TRUNCATE_SIDES = ("left", "right")
REASONING_KEYS = ("reasoning_content", "reasoning", "thinking", "reason")
ASSISTANT_ROLES = ("assistant",)


@dataclass(frozen=True)
class PrepOptions:
    """Frozen bundle of data settings; invalid values raise ``ValueError``.

    Empty ``reasoning_keys`` / ``assistant_roles`` mean the defaults, and a
    ``max_length`` of 0 or ``None`` turns truncation off.
    """

    messages_field: str = "messages"
    dataset_schema: str = "auto"
    reasoning_field: str = "reasoning_content"
    reasoning_keys: tuple[str, ...] = ()
    extract_think_tags: bool = True
    think_mode: str = "keep"
    think_max_tokens: int | None = 0
    think_role: str = "think"
    think_loss: str = "all"
    max_length: int | None = 2048
    truncate_side: str = "left"
    assistant_roles: tuple[str, ...] = ()
    drop_if_no_assistant: bool = True

    def __post_init__(self) -> None:
        if self.think_loss not in THINK_LOSS_MODES:
            raise ValueError(f"think_loss must be one of {', '.join(THINK_LOSS_MODES)}")
        if self.truncate_side not in TRUNCATE_SIDES:
            raise ValueError(f"truncate_side must be one of {', '.join(TRUNCATE_SIDES)}")

    @property
    def reasoning_sources(self) -> list[str]:
        """Fields searched, in order, when the reasoning field itself is blank."""
        keys = self.reasoning_keys or REASONING_KEYS
        return [k for k in keys if k != self.reasoning_target]

    @property
    def loss_roles(self) -> list[str]:
        return list(self.assistant_roles or ASSISTANT_ROLES)

    @property
    def reasoning_target(self) -> str:
        return self.reasoning_field or "reasoning_content"

    @property
    def limit(self) -> int:
        return self.max_length or 0

    @property
    def token_cap(self) -> int:
        return max(self.think_max_tokens or 0, 0)

    @property
    def drops_thinking(self) -> bool:
        return self.think_mode == "drop"
