"""DataFrame operators: roll-ups, latest-row picks, ordered statistics,
moments, encoders, target encoding."""
