"""Where rows come from and go to: bindings onto the event contract, the
property registry (S1), typed rows (S2), sinks (K1-K3), stored sessions."""
