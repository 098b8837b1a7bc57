"""Where rows come from: topic envelopes, layer tables, the event tables."""
