"""DataFrame -> DataFrame operators; lazy, and usable on batch and streaming frames unless noted."""
