"""Jobs, the bronze-to-gold flow, derived test inputs and the registered queries."""
