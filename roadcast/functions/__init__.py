"""roadcast.functions"""
