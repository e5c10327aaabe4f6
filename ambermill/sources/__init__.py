"""ambermill.sources"""
