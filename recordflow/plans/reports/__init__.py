"""Account reports. Every function takes the input frames and returns a lazy frame."""
