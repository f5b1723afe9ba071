"""Running streaming queries: triggers, checkpoints, watermarks, keyed state."""
