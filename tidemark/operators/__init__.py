"""DataFrame operators. Every one takes all series at once and keeps them apart by the series keys."""
